"""Language identification by a byte convolutional network, trained and run in numpy.

A text is read in windows of fixed length. Each window goes through filters of several widths over
byte embeddings, the maximum over all places, and a softmax layer; the text's distribution is the
mean over its windows, weighted by their bytes. For prediction the embedding and the filters are
multiplied out into one table for each filter offset, so a filter is a sum of looked-up rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .kernel import lean, row_blocks, text_buffer

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
EMBEDDED = 8
#: Bounds of the training sample: documents of each language, characters of each document, windows of these.
DOCS_PER_LANGUAGE = 500
CHARS_PER_DOC = 16384
WINDOWS_PER_DOC = 12
STEPS = 1200
BATCH = 128
UNDETERMINED = "und"

#: Classes of bytes: 0 for padding, white space, digits, other ASCII, letters without case, each byte of longer characters.
CLASSES = 4 + 26 + 128
_CLASS = np.array([1 if b in (0x20, *range(9, 14)) else 2 if 48 <= b < 58 else 4 + (b | 32) - 97 if chr(b).isalpha() and b < 128 else 30 + b - 128 if b > 127 else 3 for b in range(256)], np.uint8)
_LETTER = np.array([b < 128 and chr(b).isalpha() for b in range(256)])
SPAN = WINDOW + max(WIDTHS) - 1


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class matrix (windows x SPAN), row of each window, its bytes. Every byte is in the first WINDOW places of one."""
    size = np.diff(offsets)
    n = -(-size // WINDOW)
    row = np.repeat(np.arange(len(size)), n)
    k = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    start = offsets[:-1][row] + k * WINDOW
    end = offsets[1:][row]
    at = start[:, None] + np.arange(SPAN)
    out = np.where(at < end[:, None], _CLASS[data[np.minimum(at, max(len(data) - 1, 0))]], 0).astype(np.uint8) if len(row) else np.zeros((0, SPAN), np.uint8)
    return out, row, np.minimum(WINDOW, end - start)


class ByteNetwork:
    def __init__(self, languages: list[str], seed: int = 7):
        r = np.random.default_rng(seed)
        self.languages = languages
        self.p = {"e": r.normal(0, 0.5, (CLASSES, EMBEDDED)), "o": r.normal(0, 0.3, (len(WIDTHS) * FILTERS, len(languages))), "c": np.zeros(len(languages)), "b": np.zeros(len(WIDTHS) * FILTERS)}
        for w in WIDTHS:
            self.p[f"w{w}"] = r.normal(0, 0.5, (w, EMBEDDED, FILTERS))
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def tables(self):
        return {w: [np.ascontiguousarray(self.p["e"] @ self.p[f"w{w}"][o]) for o in range(w)] for w in WIDTHS}

    def pooled(self, x: np.ndarray, tables, places: bool = False):
        """Largest filter responses of each window, and where they are."""
        out, at = [], []
        for w in WIDTHS:
            y = np.take(tables[w][0], x[:, :WINDOW], axis=0)
            for o in range(1, w):
                y += np.take(tables[w][o], x[:, o : o + WINDOW], axis=0)
            if places:
                at.append(y.argmax(1))
                out.append(np.take_along_axis(y, at[-1][:, None], 1)[:, 0])
            else:
                out.append(y.max(1))
        return np.concatenate(out, 1), at

    def chances(self, pooled: np.ndarray) -> np.ndarray:
        z = np.maximum(pooled + self.p["b"], 0) @ self.p["o"] + self.p["c"]
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    def fit(self, x: np.ndarray, y: np.ndarray, seed: int = 5) -> None:
        """Adam on cross-entropy, languages drawn alike."""
        r = np.random.default_rng(seed)
        of = [np.flatnonzero(y == k) for k in range(len(self.languages))]
        m = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        for step in range(1, STEPS + 1):
            k = r.integers(0, len(of), BATCH)
            own = x[[of[j][r.integers(len(of[j]))] for j in k]]
            pooled, at = self.pooled(own, self.tables(), True)
            h = np.maximum(pooled + self.p["b"], 0)
            dz = self.chances(pooled)
            dz[np.arange(BATCH), k] -= 1
            dz /= BATCH
            dh = dz @ self.p["o"].T * (h > 0)
            g = {"o": h.T @ dz, "c": dz.sum(0), "b": dh.sum(0), "e": np.zeros_like(self.p["e"])}
            for i, w in enumerate(WIDTHS):
                d = dh[:, i * FILTERS : (i + 1) * FILTERS]
                weights = self.p[f"w{w}"]
                g[f"w{w}"] = np.zeros_like(weights)
                for o in range(w):
                    c = np.take_along_axis(own, at[i] + o, 1)  # the class under each filter's largest response
                    g[f"w{w}"][o] = np.einsum("nfe,nf->ef", self.p["e"][c], d)
                    np.add.at(g["e"], c.reshape(-1), (d[:, :, None] * weights[o].T[None]).reshape(-1, EMBEDDED))
            rate = 0.01 * min(1, 2 * (1 - step / (STEPS + 1)))
            for name, grad in g.items():
                a, b = m[name]
                a += 0.1 * (grad - a)
                b += 0.01 * (grad * grad - b)
                self.p[name] -= (rate * a / (1 - 0.9**step) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)).astype(np.float32)


def train(docs: DataFrame, learn, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> ByteNetwork | None:
    """A network fitted on rows where `learn` holds and the label is not null: at most about
    DOCS_PER_LANGUAGE documents of each language, chosen by a hash of the id, and WINDOWS_PER_DOC
    windows of CHARS_PER_DOC characters from anywhere in each. None if there is no such text."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(label_col).cast("string").alias("lang")).where(learn & F.col("lang").isNotNull() & (F.length("text") > 0))
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return None
    share = F.create_map(*(F.lit(x) for k, n in counts.items() for x in (k, min(1.0, DOCS_PER_LANGUAGE / n))))
    picked = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.get(F.array(share), F.lit(0))[F.col("lang")] * (1 << 30))
    start = F.pmod(F.xxhash64("doc_id", "lang"), F.greatest(F.length("text") - CHARS_PER_DOC, F.lit(0)) + 1).cast("int") + 1
    picked = picked.select("doc_id", F.substr("text", start, F.lit(CHARS_PER_DOC)).alias("text"), "lang").collect()
    if not picked:
        return None
    picked.sort(key=lambda p: (str(p.doc_id), p.text))
    languages = sorted({p.lang for p in picked})
    r = np.random.default_rng(3)
    x, y = [], []
    for p in picked:
        data = np.frombuffer(p.text.encode(), np.uint8)
        own = windows(data, np.array([0, len(data)]))[0]
        own = own[r.permutation(len(own))[:WINDOWS_PER_DOC]]
        x.append(own)
        y += [languages.index(p.lang)] * len(own)
    found = ByteNetwork(languages)
    found.fit(np.concatenate(x), np.array(y))
    return found


def _predict(shared):
    def run(batches):
        network = shared.value
        tables = network.tables() if network else None
        for batch in batches:
            data, offsets = text_buffer(batch.column(0))
            best, score = [], []
            for i, j in row_blocks(offsets, 1 << 18):
                part, bounds = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                letters = np.concatenate([[0], np.cumsum(_LETTER[part])])
                has = np.diff(letters[bounds]) > 0
                for k in np.flatnonzero(~has & (np.diff(bounds) > 0)):
                    raw = part[bounds[k] : bounds[k + 1]]
                    has[k] = (raw > 127).any() and any(map(str.isalpha, raw.tobytes().decode("utf-8", "replace")))
                total = np.zeros((j - i, len(network.languages) if network else 1))
                if network:
                    x, row, size = windows(part, bounds)
                    for a in range(0, len(x), 128):
                        p = network.chances(network.pooled(x[a : a + 128], tables)[0])
                        np.add.at(total, row[a : a + 128], p * size[a : a + 128, None])
                total /= np.maximum(np.diff(bounds), 1)[:, None]
                top = total.argmax(1)
                best += [network.languages[t] if h and network else UNDETERMINED for t, h in zip(top, has, strict=True)]
                score += [float(min(1.0, max(0.0, total[k, t]))) if h else 0.0 for k, (t, h) in enumerate(zip(top, has, strict=True))]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(best, pa.string()), pa.array(score, pa.float64())], [*batch.schema.names[1:], "lang_pred", "score"])

    return run


def identify(docs: DataFrame, network: ByteNetwork | None, text_col: str = "text") -> DataFrame:
    """`docs` and the columns lang_pred and score (the mean chance of that language).

    Null texts and texts without a letter are "und" with score 0, as are all without a network.
    The prediction depends on the text alone, so repeated rows have equal ones and equal chances go to
    the language that comes first; columns of the two names are replaced.
    """
    ship(docs.sparkSession)
    out = docs.drop("lang_pred", "score")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema)
    shared = docs.sparkSession.sparkContext.broadcast(network)
    return out.select(F.col(text_col).cast("string").alias("_text"), *out.columns).mapInArrow(lean(_predict(shared)), f"{fields}, lang_pred string, score double")
