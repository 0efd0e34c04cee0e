"""Plain versions of the contracts, written apart from the operators, for small inputs."""

import hashlib
import math
import re
import zlib
from array import array
from collections import Counter, defaultdict

_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text, pattern=SPACED):
    return pattern.findall((text or "").translate(_LOWER))


def crc_ids(ids):
    return zlib.crc32(array("I", ids).tobytes())


def components(nodes, links):
    root = {i: i for i in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in nodes}


def op4(rows, encode):
    out, start = {}, 0
    for doc, text in sorted(rows):
        ids = [*encode(text or ""), 0]
        out[doc] = (start, len(ids), crc_ids(ids))
        start += len(ids)
    return out


def op5(rows):
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        talks[conv].append((turn, role or "", text or ""))
    out = {}
    for conv, turns in talks.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        out[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def op6_faults(rows, pieces, encode, capacity=2048):
    """What is wrong with pieces (doc_id, start, length, crc, doc_tokens, sequence_id, offset)."""
    faults, docs, sequences = [], defaultdict(list), defaultdict(list)
    for p in pieces:
        docs[p[0]].append(p)
        sequences[p[5]].append(p)
    if set(docs) != {d for d, _ in rows}:
        faults.append("documents differ")
    for doc, text in rows:
        ids, at = [*encode(text or ""), 1], 0
        for _, start, length, crc, total, _, _ in sorted(docs[doc], key=lambda p: p[1]):
            if start != at or length < 1 or total != len(ids) or crc != crc_ids(ids[start : start + length]):
                faults.append(("piece", doc, start))
            at = start + length
        if at != len(ids):
            faults.append(("length", doc))
    for name, own in sequences.items():
        at = 0
        for p in sorted(own, key=lambda p: p[6]):
            if p[6] != at:
                faults.append(("gap", name))
            at += p[2]
        if at > capacity:
            faults.append(("too long", name))
    return faults


def op7_base(rows):
    """doc -> (n_tokens, n_known, N, base_score)."""
    split = {doc: [*words(text), None] for doc, text in rows}
    count = Counter(w for doc, ws in split.items() if zlib.crc32(str(doc).encode()) % 7 != 2 for w in ws)
    total, kinds = sum(count.values()), len(count)
    return {doc: (len(ws), sum(count[w] > 0 for w in ws), total, sum(math.log10((count[w] + 1) / (total + kinds + 1)) for w in ws)) for doc, ws in split.items()}


def shingles(text, width=5):
    w = words(text)
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set())


def op8(rows):
    sets = {doc: shingles(text) for doc, text in rows}
    index, links = defaultdict(list), []
    for doc in sorted(sets):
        shared = Counter()
        for s in sets[doc]:
            shared.update(index[s])
            index[s].append(doc)
        links += [(doc, o) for o, n in shared.items() if 100 * n >= 75 * (len(sets[doc]) + len(sets[o]) - n)]
    found = components(sets, links)
    return {doc: (len(sets[doc]), found[doc]) for doc in sets}


def op9(rows, threshold=0.9):
    """rows: (vec_id, list or None) -> vec_id -> (n_links, component, kept)."""
    import numpy as np

    good = [(i, v) for i, v in rows if v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links, by = [], defaultdict(list)
    for i, v in good:
        by[len(v)].append((i, np.array(v, np.float64)))
    for own in by.values():
        m = np.array([v for _, v in own])
        m /= np.sqrt((m * m).sum(1, keepdims=True))
        for k in range(len(own)):
            links += [(own[k][0], own[j][0]) for j in np.flatnonzero(m[k + 1 :] @ m[k] >= threshold) + k + 1]
    found, n = components([i for i, _ in rows], links), Counter(x for pair in links for x in pair)
    return {i: (n[i], found[i], found[i] == i) for i, _ in rows}


def op10(docs, items, window=10):
    split = {}
    for item, text in items:
        w = words(text, ALNUM)
        split.setdefault(item, []).append(w)
    spans = defaultdict(set)
    for item, texts in split.items():
        for w in texts:
            n = min(window, len(w))
            for i in range(len(w) - n + 1) if n else ():
                spans[tuple(w[i : i + n])].add(item)
    sizes, out = {len(s) for s in spans}, {}
    for doc, text in docs:
        w, hit, found = words(text, ALNUM), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if own := spans.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    found |= own
        out[doc] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit))
    return out


def repeated_words(rows, size=50):
    """doc -> words inside a run of `size` words that a document of smaller id has too."""
    first, split = {}, {doc: words(text) for doc, text in rows}
    for doc in sorted(split):
        for i in range(len(split[doc]) - size + 1):
            first.setdefault(tuple(split[doc][i : i + size]), doc)
    out = {}
    for doc, w in split.items():
        hit = set()
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] < doc:
                hit.update(range(i, i + size))
        out[doc] = hit
    return out


def lm_log_chances(model, ids):
    """Natural logarithms of the ids' chances, place by place, from the model's parameters."""
    import numpy as np
    from tidemark.llm.attention_lm import CONTEXT, MEMBERS, STRIDE, WIDTH

    def log_softmax(z):
        z = np.asarray(z, np.float64)
        return z - z.max() - math.log(sum(math.exp(v - z.max()) for v in z))

    p, out = model.p, []
    before = [0, *(int(model.target[i]) + 1 for i in ids[:-1])]
    for t, i in enumerate(ids):
        seen = range(max(0, t // STRIDE * STRIDE - CONTEXT), t + 1)
        query = p["e"][before[t]] @ p["q"]
        z = log_softmax([query @ (p["e"][before[u]] @ p["k"]) / math.sqrt(WIDTH) + p["pos"][t - u] for u in seen])
        h = p["e"][before[t]] + sum(math.exp(a) * (p["e"][before[u]] @ p["v"]) for a, u in zip(z, seen, strict=True))
        g = h + np.maximum(h @ p["w1"] + p["b1"], 0) @ p["w2"]
        group, member = divmod(int(model.target[i]), MEMBERS)
        chance = log_softmax(g @ p["out"] + p["pair"][before[t]])[group] + log_softmax(g @ p["member"][group] + model.inner[before[t], group])[member]
        out.append(chance + model.share[i])
    return out


def op11_counts(rows):
    """rows: (doc_id, text) -> word -> n, of the words that the contract keeps."""
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(_LOWER)
            h = zlib.crc32(f"{doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 7
    return {w: n for w, n in counts.items() if n >= 2}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def op11_forms(counts, ratio=10):
    """word -> (form, root, n, n_near, form_n), every pair of words compared."""
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    forms = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best is not None and counts[best] >= ratio * n else None
    out = {}
    for w, n in counts.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out[w] = (forms[w], root, n, len(near[w]), counts.get(forms[w]))
    return out


def op12_targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """source -> target, of source -> size: the excess over a source's most is shared again among the others."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    fixed, left = {}, sum(sizes.values()) * share
    while True:
        free = [s for s in names if s not in fixed]
        total = sum(weight[s] for s in free)
        target = {s: left * weight[s] / total for s in free} if free else {}
        above = [s for s in free if target[s] > most * sizes[s]]
        if not above:
            return fixed | target
        for s in above:
            fixed[s] = float(most * sizes[s])
            left -= fixed[s]


def best_sum(sizes, budget):
    """The least distance from the budget that a subset's sum can have."""
    sums = {0}
    for size in sizes:
        sums |= {s + size for s in sums}
    return min(abs(s - budget) for s in sums)


def op13_words(doc, text):
    w = SPACED.findall(text or "")
    h = zlib.crc32(str(doc).encode())
    if h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    return w


def runs(w, exponent=4, least=6):
    """All runs (start, length, shortest period), by trying every period at every place."""
    out = {}
    for p in range(1, len(w) // exponent + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            if j - i + p >= max(least, exponent * p):
                out.setdefault((i, j - i + p), p)
            i = max(j, i + 1)
    return sorted((i, n, p) for (i, n), p in out.items())


def op13(rows):
    from fractions import Fraction

    out = {}
    for doc, text in rows:
        w = op13_words(doc, text)
        found = runs(w)
        gone = {i for start, n, p in found for i in range(start + p, start + n)}
        best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
        lines = "".join(f"{a},{n},{p}\n" for a, n, p in found)
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[doc] = (len(found), *(best or (None, None, None)), best and 1000 * best[1] // best[2], hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())
    return out
