"""Subtitle files to cues, rolling-overlap removal, transcripts; all inside one row per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.binding import exploded, let
from ..functions.folding import fold
from ..functions.text import WS, clean_caption_text, normalized_transcript, sha256_text, strip, token_keys, tokens
from ..session import scratch

#: The overlap window, timing lines, metadata lines and comment blocks of subtitle files.
LONGEST_OVERLAP = 40
TIME = r"(?:\p{Nd}{1,2}:)?\p{Nd}{2}:\p{Nd}{2}[,.]\p{Nd}{3}"
TIMING = rf"\A({TIME}){WS}+-->{WS}+({TIME})(?:{WS}+.*)?\z"
METADATA = ("Kind:", "Language:", "X-TIMESTAMP-MAP")
COMMENTS = ("NOTE", "STYLE", "REGION")
LINE_ENDS = r"[\n\x0B\x0C\x1C\x1D\x1E\x85\x{2028}\x{2029}]"
CUES = "array<struct<start:string,end:string,text:string>>"


def decode_file(content: Column) -> Column:
    """UTF-8 text with bad bytes replaced and a byte-order mark removed."""
    return F.regexp_replace(F.make_valid_utf8(content.cast("string")), r"\A\x{FEFF}", "")


def cue_parts(raw: Column) -> Column:
    """array<struct(start, end, text)> with the cue texts still as they are written."""
    blocks = F.split(F.regexp_replace(raw, "\r\n?", "\n"), rf"\n{WS}*\n", -1)
    lined = F.transform(blocks, lambda b: F.filter(F.transform(F.split(b, LINE_ENDS, -1), strip), lambda line: line != ""))
    is_metadata = lambda line: F.startswith(line, F.lit(METADATA[0])) | F.startswith(line, F.lit(METADATA[1])) | F.startswith(line, F.lit(METADATA[2]))

    is_timing = lambda line: F.contains(line, F.lit("-->")) & line.rlike(TIMING)

    def kept(lines: Column) -> Column:
        first = F.upper(F.left(F.ltrim(F.get(lines, F.lit(0)), F.lit("\ufeff")), F.lit(len("WEBVTT") + 1)))
        comment = let(first, lambda x: (x == "WEBVTT") | F.startswith(x, F.lit(COMMENTS[0])) | F.startswith(x, F.lit(COMMENTS[1])) | F.startswith(x, F.lit(COMMENTS[2])))
        unmarked = let(F.exists(lines, is_metadata), lambda some: ~(some & (F.forall(lines, is_metadata) | ~F.exists(lines, is_timing))))
        return (F.size(lines) > 0) & ~comment & unmarked

    def cue(lines: Column) -> Column:
        timed = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: is_timing(F.get(lines, i)))
        return let(F.get(timed, F.lit(0)), lambda at: made(lines, at))

    def made(lines: Column, at: Column) -> Column:
        line = F.get(lines, at)
        body = F.when(at.isNotNull(), F.slice(lines, at + 2, F.size(lines))).otherwise(F.filter(lines, lambda x: ~x.rlike(r"\A\p{Nd}+\z")))
        pick = lambda k: F.when(at.isNotNull(), F.regexp_extract(line, TIMING, k))
        return F.struct(pick(1).alias("start"), pick(2).alias("end"), F.array_join(body, " ").alias("text"))

    return F.transform(F.filter(lined, kept), cue)


def with_text(cues: Column, clean) -> Column:
    """The cues with `clean` applied to their texts, and those without text left out."""
    cleaned = F.transform(cues, lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), clean(c["text"]).alias("text")))
    return F.filter(cleaned, lambda c: c["text"] != "")


def parse_cues(files: DataFrame, raw_col: str = "raw") -> DataFrame:
    """`files` with a column `cues`."""
    return files.withColumn("cues", with_text(cue_parts(F.col(raw_col)), clean_caption_text))


def prepared(text: Column) -> Column:
    return F.struct(text.alias("text"), fold(text).alias("fold"), token_keys(text).alias("keys"))


def residual(previous: Column, current: Column) -> Column:
    """What `current` adds to `previous` (both `prepared`): the longest run of 2 to 40 token keys that ends the one and begins the other goes."""
    most = F.least(F.size(previous["keys"]), F.size(current["keys"]), F.lit(LONGEST_OVERLAP))
    tail, head = F.slice(previous["keys"], F.size(previous["keys"]) - most + 1, most), F.slice(current["keys"], F.lit(1), most)

    def longest(ends: Column) -> Column:
        """The first key's places in the tail, the earliest first: there the two must agree up to the tail's end."""

        def same(i: Column) -> Column:
            return (F.get(ends["tail"], i) == F.get(ends["head"], F.lit(0))) & (F.slice(ends["tail"], i + 1, most - i) == F.slice(ends["head"], F.lit(1), most - i))

        return most - F.get(F.filter(F.sequence(F.lit(0), most - 2), same), F.lit(0))

    size = F.when((most >= 2) & F.arrays_overlap(F.slice(tail, F.lit(1), F.greatest(most - 1, F.lit(1))), F.slice(current["keys"], F.lit(1), F.lit(1))), let(F.struct(tail.alias("tail"), head.alias("head")), longest))
    rest = lambda n: F.array_join(let(tokens(current["text"]), lambda words: F.slice(words, n + 1, F.greatest(F.size(words) - n, F.lit(0)))), " ")
    return (
        F.when(previous.isNull() | (previous["text"] == ""), current["text"])
        .when(previous["fold"] == current["fold"], "")
        .otherwise(let(size, lambda n: F.when(n.isNotNull(), rest(n)).otherwise(current["text"])))
    )


def without_overlap(frame: DataFrame, cues_col: str = "cues") -> DataFrame:
    """`frame` with a column `segments`: each cue less what the whole cue before it said; emptied cues go.

    Only the neighbouring original cue matters, so each array is paired with itself shifted by one:
    no shuffle, no growing state, and legal in streams.
    """
    out = frame.withColumn("_now", F.transform(cues_col, lambda c: prepared(c["text"])))
    before = F.concat(F.array(F.lit(None).cast(_PREPARED)), F.slice("_now", F.lit(1), F.greatest(F.size("_now") - 1, F.lit(0))))
    out = out.withColumn("_left", F.when(F.size("_now") > 0, F.zip_with(before, F.col("_now"), residual)).otherwise(F.array().cast("array<string>")))
    joined = F.zip_with(F.col(cues_col), F.col("_left"), lambda c, t: F.struct(c["start"].alias("start"), c["end"].alias("end"), t.alias("text")))
    return out.withColumn("segments", F.filter(joined, lambda c: c["text"] != "")).drop("_now", "_left")


_PREPARED = "struct<text:string,fold:string,keys:array<string>>"


def overlap_by_chunks(lines: DataFrame, by: str, order: str, text: str, size: int = 256) -> DataFrame:
    """`lines` with a column `residual`: the same on one row for each cue, for sequences of any length.

    The cues are dealt by range of sequence and order, so that a long sequence lies in many partitions, and taken in chunks
    of `size` neighbours. The last cue of each chunk is carried over to the next one, and inside a chunk it goes as in
    `without_overlap`. `order` differs within a sequence. Null texts count as empty; emptied cues go.
    """
    spark = lines.sparkSession
    key = [F.col(by).asc_nulls_first(), F.col(order).asc_nulls_first()]
    at = F.monotonically_increasing_id()  # the partition, and the place in it
    dealt = lines.repartitionByRange(*key).sortWithinPartitions(*key).withColumn("_at", at)
    place = scratch(spark, "cue-chunks")
    dealt.withColumn("_chunk", F.floor(F.col("_at") / size)).write.parquet(place)
    rows = spark.read.parquet(place)
    own = F.struct(*[F.col(c) for c in lines.columns])
    cue = F.struct(F.col("_at").alias("at"), F.col(by).alias("by"), F.coalesce(text, F.lit("")).alias("text"), own.alias("own"))
    chunks = rows.groupBy("_chunk").agg(F.array_sort(F.collect_list(cue)).alias("cues"))
    # inside a partition the next chunk has the next number; a partition's last one goes on with the first of the next partition that has any
    parts = rows.groupBy(F.shiftrightunsigned("_at", 33).alias("part")).agg(F.max("_chunk").alias("last"), F.min("_chunk").alias("first"))
    ends = sorted((r.part, r.last, r.first) for r in parts.collect())  # one row for each partition
    steps = spark.createDataFrame([(a[1], b[2]) for a, b in zip(ends, ends[1:], strict=False)], "_chunk long, next long")
    last = rows.groupBy("_chunk").agg(F.max_by(F.struct(F.col(by).alias("by"), F.coalesce(text, F.lit("")).alias("text")), "_at").alias("carried"))
    carried = last.join(F.broadcast(steps), "_chunk", "left").select(F.coalesce("next", F.col("_chunk") + 1).alias("_chunk"), "carried")
    both = chunks.join(carried, "_chunk", "left")
    ready = lambda c: F.struct(c["by"].alias("by"), prepared(c["text"]).alias("now"))
    both = both.withColumn("_now", F.transform("cues", ready)).withColumn("_first", F.when(F.col("carried").isNotNull(), ready(F.col("carried"))))
    before = F.concat(F.array("_first"), F.slice("_now", F.lit(1), F.size("_now") - 1))
    left = F.zip_with(before, F.col("_now"), lambda p, c: residual(F.when(p["by"].eqNullSafe(c["by"]), p["now"]), c["now"]))
    found = both.select(F.zip_with("cues", left, lambda c, r: F.struct(c["own"].alias("own"), r.alias("residual"))).alias("_found"))
    return exploded(found, "_found", "f").where("f.residual <> ''").select("f.own.*", "f.residual")


def transcripts(frame: DataFrame, segments_col: str = "segments") -> DataFrame:
    """`frame` with transcript (normalised, null where there is no text), transcript_sha256, transcript_chars and cue_count."""
    text = strip(F.array_join(F.transform(segments_col, lambda c: c["text"]), "\n"))
    out = frame.withColumn("_text", text)
    out = out.withColumn("transcript", F.when(F.col("_text") != "", normalized_transcript(F.col("_text"))))
    return out.withColumns({"transcript_sha256": sha256_text(F.col("transcript")), "transcript_chars": F.coalesce(F.length("transcript"), F.lit(0)).cast("long"), "cue_count": F.size(segments_col).cast("long")}).drop("_text")


def first_usable_file(files: DataFrame, by: str, path_col: str = "path") -> DataFrame:
    """For each request the file with text whose path comes first, with its format."""
    rest = [c for c in files.columns if c not in (by, path_col)]
    # a filter on the text would be pushed below it, and the text be computed twice
    best = files.groupBy(by).agg(F.min(F.when(F.col("transcript").isNotNull(), F.struct(path_col, *rest))).alias("best")).where("best is not null")
    return best.select(by, "best.*").withColumn("format", F.regexp_extract(path_col, r"\.([^.]*)\z", 1))
