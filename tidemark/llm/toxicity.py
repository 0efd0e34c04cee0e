"""Toxicity by a learned lexicon, Levenshtein automata over its trie, and the context of each hit.

The lexicon comes from labelled texts: words, and stems (beginnings of words that go on in many
ways), that toxic texts hold far more often than chance allows. Every distinct word of a text is
read by the Levenshtein automaton of the word in step with the trie of all terms, so that
misspelled terms are found too; how far a misspelling counts is learned for each distance. A hit
inside quotation marks, or after a word of reporting, counts less than plain abuse.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .kernel import ALNUM, LOWER, Memo, kept, mix, row_blocks, seeds, shingle_hashes, text_buffer, word_bounds, word_hashes

#: Bounds of the training sample: documents of label 0 and of label 1.
DOCS_PER_LABEL = (4000, 2000)
STEM_LENGTHS = (4, 5, 6, 7, 8)
LEAST_SHARE = 0.6
COPY_HASHES = 4
#: A misspelling counts as PRIOR until labelled texts that hold one say otherwise; the prior weighs as much as PRIOR_DOCS of them.
PRIOR, PRIOR_DOCS = 0.85, 5
#: Occurrences of a term in a text that are told apart.
MOST = 4
CONTEXT_WORDS = 4
CONTEXT_BYTES = 80
QUOTED, REPORTED = 0.45, 0.6
#: Opening and closing quotation marks, and words of reporting in four languages.
QUOTES = '"“”„«»‟'
REPORTING = frozenset("said says wrote writes called calls quote quoted quotes term word words slur insult dit disait appelle mot mots insulte sagte sagt schrieb nannte wort zitat beleidigung dijo dice escribió llamó palabra insulto".split())


def reach(term: str) -> int:
    """Edits within which a word counts as a misspelling of the term."""
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Trie:
    """Terms as a trie. A stem matches every word that begins with it; only whole words match with edits."""

    def __init__(self, words: list[str], stems: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.term, self.stem, self.limit = [-1], [-1], [0]
        for k, word in enumerate(words):
            self.term[self._add(word, reach(word))] = k
        for k, stem in enumerate(stems, len(words)):
            self.stem[self._add(stem, 0)] = k
        # One edit leaves the first or the last half of a term as it was; two edits leave one of three
        # pieces, the middle one moved by two places at most. By length: what a misspelling looks like.
        parts: dict[int, list[str]] = {}
        for word in words:
            if d := reach(word):
                cut = [len(word) * k // (d + 1) for k in range(d + 2)]
                pieces = [word[x:y] for x, y in zip(cut, cut[1:], strict=False)]
                forms = [f"^{re.escape(pieces[0])}", f"{re.escape(pieces[-1])}$", *(f"^.{{{max(0, x - d)},{x + d}}}{re.escape(p)}" for x, p in zip(cut[1:], pieces[1:-1], strict=False))]
                for size in range(len(word) - d, len(word) + d + 1):
                    parts.setdefault(size, []).extend(forms)
        self.looks = {size: re.compile("|".join(dict.fromkeys(forms))).search for size, forms in parts.items()}

    def _add(self, word: str, limit: int) -> int:
        node = 0
        for c in word:
            self.limit[node] = max(self.limit[node], limit)
            if c not in self.children[node]:
                self.children[node][c] = len(self.children)
                self.children.append({})
                self.term.append(-1)
                self.stem.append(-1)
                self.limit.append(0)
            node = self.children[node][c]
        self.limit[node] = max(self.limit[node], limit)
        return node

    def exact(self, word: str) -> int:
        """The word's term, or its longest stem, or -1."""
        node, found = 0, -1
        for c in word:
            node = self.children[node].get(c, -1)
            if node < 0:
                return found
            if self.stem[node] >= 0:
                found = self.stem[node]
        return self.term[node] if self.term[node] >= 0 else found

    def near(self, word: str) -> tuple[int, int]:
        """The nearest term within its reach and the distance, or (-1, 0): the automaton's state is the
        set of distances to the word's beginnings, and a branch of the trie ends where all exceed its reach."""
        best = (9, -1)
        stack = [(0, list(range(len(word) + 1)))]
        while stack:
            node, row = stack.pop()
            if self.term[node] >= 0 and row[-1] <= self.limit[node]:
                best = min(best, (row[-1], self.term[node]))
            for c, child in self.children[node].items():
                new = [row[0] + 1]
                for k, x in enumerate(word, 1):
                    new.append(min(new[-1] + 1, row[k] + 1, row[k - 1] + (x != c)))
                if min(new) <= self.limit[child]:
                    stack.append((child, new))
        return (best[1], best[0]) if best[1] >= 0 else (-1, 0)

    def match(self, word: str, known: frozenset[str] | set[str] = frozenset()) -> tuple[int, int]:
        """(term, distance) or (-1, 0). `known` words are clean ones, not misspellings."""
        k = self.exact(word)
        if k >= 0:
            return k, 0
        look = self.looks.get(len(word))
        if look is None or not look(word) or word in known:
            return -1, 0
        return self.near(word)


class Lexicon:
    """Terms with the chance that a text that holds one is toxic."""

    def __init__(self, words: list[str], stems: list[str], chance: list[list[float]], near: dict[tuple[int, int], float], known: set[str]):
        self.trie, self.chance, self.near_chance, self.known = Trie(words, stems), chance, near, known

    def weight(self, term: int, distance: int, count: int = 1) -> float:
        """The chance by the term, its distance and its occurrences in the text (MOST or more are alike)."""
        return self.chance[term][min(count, MOST) - 1] * (self.near_chance.get((term, distance), PRIOR) if distance else 1.0)


def text_words(text: str) -> list[str]:
    raw = LOWER[np.frombuffer(text.encode(), np.uint8)]
    starts, ends, _ = word_bounds(raw, np.array([0, len(raw)]), ALNUM)
    raw = raw.tobytes()
    return [raw[a:b].decode("utf-8", "replace") for a, b in zip(starts, ends, strict=True)]


def learn(toxic: list[Counter], clean: list[Counter], weight: float = 1.0) -> Lexicon:
    """From the counted words of labelled texts. `weight`: clean texts of the corpus for each one here.

    A term must be likelier than all candidate terms' number of trials could make it: its
    log-likelihood gain over the base rate exceeds the logarithm of that number.
    """
    base = len(toxic) / max(len(toxic) + len(clean), 1)

    def counted(sets: list[Counter], parts) -> Counter:
        found: Counter = Counter()
        for s in sets:
            found.update({p for w in s for p in parts(w)})
        return found

    def gain(p: int, n: int) -> float:
        share = p / (p + n)
        return p * math.log(share / base) + (n * math.log((1 - share) / (1 - base)) if n else 0.0)

    def chosen(parts) -> dict[str, tuple[int, int]]:
        if not 0 < base < 1:
            return {}
        p, n = counted(toxic, parts), counted(clean, parts)
        least = math.log(len(p) + 2) + 3
        return {t: (k, n[t]) for t, k in p.items() if k >= 3 and k / (k + n[t] * weight) >= LEAST_SHARE and gain(k, n[t]) > least}

    words = chosen(lambda w: (w,))
    stems = chosen(lambda w: {w[:k] for k in STEM_LENGTHS if len(w) > k})
    # a stem must go on in several ways, and say more than each of its continuations
    kept: dict[str, tuple[int, int]] = {}
    for stem in sorted(stems, key=len):
        if any(stem.startswith(s) for s in kept):
            continue
        p, n = stems[stem]
        most = max((words[w][0] for w in words if w.startswith(stem)), default=0)
        if p >= 1.5 * max(most, 2):
            kept[stem] = (p, n)
    own = {w: c for w, c in words.items() if not any(w.startswith(s) for s in kept)}
    terms = {**own, **kept}
    single = [(p + 0.5) / (p + n * weight + 0.7) for p, n in terms.values()]
    lexicon = Lexicon(list(own), list(kept), [[x] * MOST for x in single], {}, set())
    near: dict[tuple[int, int], list[float]] = {}
    count = counted(clean, lambda w: (w,))
    cache: dict[str, tuple[int, int]] = {}
    by_count = np.zeros((2, len(terms), MOST))
    for label, sets in ((1, toxic), (0, clean)):
        for s in sets:
            times: Counter = Counter()
            for w, k in s.items():
                if w not in cache:
                    cache[w] = lexicon.trie.match(w)
                if cache[w][0] >= 0 and not cache[w][1]:
                    times[cache[w][0]] += k
            for term, k in times.items():
                by_count[label, term, min(k, MOST) - 1] += 1 if label else weight
            hits = {cache[w] for w in s if cache[w][0] >= 0}
            if label and any(d == 0 for _, d in hits):
                continue  # it says nothing on the misspelling
            for hit in hits:
                if hit[1]:
                    near.setdefault(hit, [0.0, 0.0])[label] += 1 if label else weight
    for term, share in enumerate(single):
        for k in range(MOST):  # few texts with so many occurrences: shrink towards the term's own chance, never below fewer occurrences
            p, n = by_count[1, term, k], by_count[0, term, k]
            share = max(share if k else 0.0, (p + 2 * share) / (p + n + 2))
            lexicon.chance[term][k] = share
    lexicon.known = {w for w, hit in cache.items() if hit[1] and count[w] >= 2}
    lexicon.near_chance = {hit: (p + PRIOR * PRIOR_DOCS) / (p + n + PRIOR_DOCS) for hit, (n, p) in near.items()}
    return lexicon


def train(docs: DataFrame, labels: DataFrame, chosen, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Lexicon:
    """A lexicon from labelled rows where `chosen` holds: at most about DOCS_PER_LABEL texts of each label, by a hash of the id."""
    ship(docs.sparkSession)
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("label")).where("label in (0, 1)").where(chosen("id"))
    counts = {r.label: r["count"] for r in marks.groupBy("label").count().collect()}
    share = {k: min(1.0, DOCS_PER_LABEL[k] / max(counts.get(k, 0), 1)) for k in (0, 1)}
    picked = marks.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < F.when(F.col("label") == 1, share[1]).otherwise(share[0]) * (1 << 30))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    found = sorted(tuple(r) for r in rows.join(F.broadcast(picked), "id").select("id", "label", "text").toLocalIterator())
    words: dict[int, list[Counter]] = {0: [], 1: []}
    for (_, label, text), new in zip(found, first_of_copies([text for _, _, text in found]), strict=True):
        if new:
            words[label].append(Counter(text_words(text)))
    return learn(words[1], words[0], 1 / share[0] * share[1] if counts else 1.0)


def first_of_copies(texts: list[str]) -> list[bool]:
    """Whether each text shares none of COPY_HASHES min-hashes of its shingles with an earlier one: a group of copies is one witness."""
    seen: set[tuple[int, int]] = set()
    salts, out = seeds(COPY_HASHES, 53), []
    for text in texts:
        shingles, _ = shingle_hashes(*word_hashes(*text_buffer(pa.array([text], pa.large_string()))))
        own = {(k, int(mix(shingles ^ salt).min())) for k, salt in enumerate(salts)} if len(shingles) else set()
        out.append(not own & seen)
        seen |= own
    return out


class WordMemo(Memo):
    """For each word nothing, or its term * 4 + distance; 4 less for reporting words (value 2**31)."""

    SAYS = 1 << 31

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        super().__init__(1_500_000, LOWER)

    def compute(self, texts: list[str]) -> list[list[int]]:
        out, match, known = [], self.lexicon.trie.match, self.lexicon.known
        for word in texts:
            term, distance = match(word, known)
            out.append([term * 4 + distance] if term >= 0 else [self.SAYS] if word in REPORTING else [])
        return out


def context_factor(before: str, after: str, reported: bool) -> float:
    """What a hit counts by its surroundings: less inside a pair of quotation marks or after a word of reporting."""
    inside = any(c in QUOTES for c in before) and any(c in QUOTES for c in after) and sum(c == '"' for c in before) % 2 == (0 if any(c in "“„«‟»" for c in before) else 1)
    return (QUOTED if inside else 1.0) * (REPORTED if reported else 1.0)


def _score(shared, key: str):
    def run(batches):
        memo = kept(("words", key), lambda: WordMemo(shared.value))
        for batch in batches:
            data, offsets = text_buffer(batch.column(0))
            score = np.zeros(len(batch))
            hits: list[int] = [0] * len(batch)
            for i, j in row_blocks(offsets):
                part, bounds = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                starts, ends, rows = word_bounds(part, bounds, ALNUM)
                entry = memo.entries(part, starts, ends)
                at = np.flatnonzero(memo.size[entry] > 0)
                value = memo.ids[memo.first[entry[at]]]
                says = at[value == memo.SAYS]
                best: dict[int, dict[int, float]] = {}
                found = [(w, v, int(r)) for w, v, r in zip(at.tolist(), value.tolist(), np.searchsorted(rows, at, "right") - 1, strict=True) if v != memo.SAYS]
                times = Counter((r, v >> 2) for _, v, r in found)
                for w, v, row in found:
                    plain = memo.lexicon.weight(v >> 2, v & 3, times[row, v >> 2])
                    own = best.setdefault(row, {})
                    hits[i + row] += 1
                    if own.get(v >> 2, 0) >= plain:
                        continue
                    a, b = max(bounds[row], starts[w] - CONTEXT_BYTES), min(bounds[row + 1], ends[w] + CONTEXT_BYTES)
                    near = says[np.searchsorted(says, max(rows[row], w - CONTEXT_WORDS)) : np.searchsorted(says, w)]
                    factor = context_factor(part[a : starts[w]].tobytes().decode("utf-8", "ignore"), part[ends[w] : b].tobytes().decode("utf-8", "ignore"), len(near) > 0)
                    own[v >> 2] = max(own.get(v >> 2, 0), plain * factor)
                for row, own in best.items():
                    score[i + row] = 1 - math.prod(1 - x for x in own.values())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(score), pa.array(hits, pa.int64())], [*batch.schema.names[1:], "score", "n_hits"])

    return run


def score(docs: DataFrame, lexicon: Lexicon, text_col: str = "text") -> DataFrame:
    """`docs` and the columns score (0 to 1) and n_hits (words that match a term).

    Terms count as independent signs, each with its number of occurrences and its most telling one. Null and empty texts
    score 0. The score depends on the text alone, so repeated rows have equal ones; of a word's terms at
    one distance the first learned counts; columns of the two names are replaced.
    """
    ship(docs.sparkSession)
    out = docs.drop("score", "n_hits")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema)
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(lexicon)
    return out.select(F.col(text_col).cast("string").alias("_text"), *out.columns).mapInArrow(_score(shared, f"{context.applicationId}-{shared._jbroadcast.id()}"), f"{fields}, score double, n_hits long")
