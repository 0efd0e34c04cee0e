"""Searching all texts for all terms of a table, in one pass over each text for many terms at once.

The terms are dealt into shards of bounded size; each shard becomes an Aho-Corasick automaton in the
tasks, which reads a text once however many terms the shard has. So the time hardly depends on
the number of terms, and no text is paired with a term that it doesn't hold.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.folding import fold
from ..session import ship

#: Bytes of terms in a shard: what a task's automaton holds, and what the driver sends at a time.
SHARD_BYTES = 1 << 20
_ROWS = 50_000
_BUILT: dict = {}


def _automaton(shard: Broadcast):
    """The worker's automaton of a shard, kept until another one is asked for. Its values are the numbers of the terms that a folded one stands for."""
    import ahocorasick

    if _BUILT.get("shard") is not shard:
        folded: dict[str, list[int]] = {}
        for number, (_, key) in enumerate(shard.value):
            folded.setdefault(key, []).append(number)
        built = ahocorasick.Automaton()
        for key, numbers in folded.items():
            built.add_word(key, tuple(numbers))
        built.make_automaton()
        _BUILT.update(shard=shard, automaton=built)
    return _BUILT["automaton"]


def _search(shard: Broadcast):
    def run(batches):
        automaton = _automaton(shard)
        terms = pa.array([term for term, _ in shard.value], pa.string())
        for batch in batches:
            keys = batch.num_columns - 1

            def rows(at, hits, batch=batch, keys=keys):
                taken = pa.array(at, pa.int64())
                return pa.RecordBatch.from_arrays([*(batch.column(k).take(taken) for k in range(keys)), terms.take(pa.array(hits, pa.int64()))], [*batch.schema.names[:-1], "_text"])

            at, hits = [], []
            for k, text in enumerate(batch.column(keys).to_pylist()):
                if text:
                    own = {number for _, numbers in automaton.iter(text) for number in numbers}
                    at += [k] * len(own)
                    hits += own
                    if len(at) >= _ROWS:
                        yield rows(at, hits)
                        at, hits = [], []
            if at:
                yield rows(at, hits)

    return run


def scan_terms(texts: DataFrame, terms: DataFrame, text_col: str = "text", term_col: str = "term", any_case: bool = True, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The other columns of `texts` with `term`, one row for each row of `texts` and each distinct term that it holds.

    With `any_case` both are case-folded in full before they are compared, and terms that fold alike are all given.
    Null texts hold nothing, null terms are left out, the empty term is in every text that isn't null. Repeated rows are
    searched each by itself. An own column `term` of the texts is left out. Terms beyond `shard_bytes` take one
    pass over the texts for each such amount; a shard goes through the driver, and the next one after it.
    """
    spark = texts.sparkSession
    ship(spark)
    same = fold if any_case else (lambda x: x)
    names = [c for c in texts.columns if c not in (text_col, "term")]
    searched = texts.select(*[F.col(f"`{c}`").alias(f"_{k}") for k, c in enumerate(names)], same(F.col(text_col).cast("string")).alias("_text"))
    given = lambda frame, term: frame.select(*[F.col(f"_{k}").alias(c) for k, c in enumerate(names)], term.alias("term"))
    named = terms.select(F.col(term_col).cast("string").alias("term")).where("term is not null").distinct().select("term", same(F.col("term")).alias("folded"))
    size = named.agg(F.sum(F.octet_length("term") + F.octet_length("folded"))).first()[0] or 0
    shards = max(1, -(-size // (2 * shard_bytes)))
    schema = ", ".join(f"`{c}` {t}" for c, t in searched.dtypes)
    parts = []
    for number in range(shards):
        own = named.where((F.pmod(F.xxhash64("folded"), F.lit(shards)) == number) & (F.col("folded") != "")).collect()
        if own:
            shard = spark.sparkContext.broadcast(sorted(map(tuple, own)))
            parts.append(given(searched.mapInArrow(_search(shard), schema), F.col("_text")))
    if named.where("folded = ''").take(1):
        parts.append(given(searched.where("_text is not null"), F.lit("")))
    return reduce(DataFrame.unionByName, parts) if parts else given(searched.limit(0), F.lit(""))
