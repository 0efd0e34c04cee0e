"""Language-model scoring by a causal self-attention model over subword ids, in numpy.

A text's subword ids are cut into windows that overlap: each predicts its last STRIDE ids from all
ids before them in the window, so every id is scored once and with at least CONTEXT ids before it.
Ids are put into classes and classes into groups. One attention head with learned relative positions
and one hidden layer give, on top of tables of what follows what, the chances of all groups and of
the classes within a group; an id's chance within its class is its share there, smoothed so that
every id of the vocabulary has one. Chances add up to 1 over the vocabulary.

All that is learnt comes from all learnt texts: shares, classes and tables count every id, a word's
chance is mostly that of its ids, and MIXED of it its share among the words of all learnt texts,
whatever its count. The network's weights are trained on every window of every learnt text: texts
are dealt into blocks by a hash, blocks learn side by side from the same weights, and the mean of
their changes starts the next round. Besides, each text has the score of a plain unigram model over
words, with counts from all.

Words are counted and looked up in buckets as packed columns; only the most frequent ones, at most
HEAVY, are sent to all tasks, so that no bucket meets a word that a large share of texts hold. Other
words go to their buckets with the model's chance, and are mixed there; both ways give the same,
and the buckets' number changes no score but for the order in which floats are added.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .common import sized, spill
from .kernel import expand, lean, lean_group, mix, row_blocks, seeds, text_buffer, tokenizer, tokenizer_key, with_end, word_hashes

_U = np.uint64
CONTEXT, STRIDE = 8, 24
WINDOW = CONTEXT + STRIDE
WIDTH, HIDDEN = 16, 32
#: Groups of MEMBERS classes each; the OWN most frequent ids are classes of their own.
GROUPS, MEMBERS = 32, 32
CLASSES, OWN = GROUPS * MEMBERS, 960
#: Ids whose places beside a rare id tell which rare ids are alike.
NEIGHBOURS = 80
#: Training steps at least, with windows used again where the texts have fewer; and windows of a step, more of them while the texts give STEPS steps.
STEPS, BATCH, LARGE_BATCH = 2500, 48, 256
#: Rounds of training, bytes of text for one block of them, and ids of a piece that stays together.
ROUNDS, BLOCK_BYTES, TOGETHER = 6, 1 << 22, STRIDE << 12
#: A piece inside a text begins with what its first window looks back at.
LEAD = CONTEXT + 1
#: Changes of weights are added up as whole numbers, so that their order doesn't matter.
UNIT = 1 << 24
HEAVY = 1 << 19
#: How much of a word's chance comes from the words' counts.
MIXED = 0.2
#: Weights of the plain shares in the neighbour tables: of groups, and of classes within a group.
PAIR_PRIOR = (20, 10)
END_WORD = seeds(1, 97)[0]
#: Bytes of text for one bucket of words, and slots of one piece of the id counts.
BUCKET_BYTES, PIECE = 1 << 26, 1 << 14


def _halves(features: np.ndarray, members: np.ndarray, least: int) -> list[np.ndarray]:
    """`members` in parts of `least`, each halving along the direction in which the features differ most."""
    if len(members) <= least:
        return [members]
    x = features[members] - features[members].mean(0)
    _, vectors = np.linalg.eigh(x @ x.T)
    order = members[np.argsort(vectors[:, -1], kind="stable")]
    return _halves(features, order[: len(order) // 2], least) + _halves(features, order[len(order) // 2 :], least)


def _bins(places: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    """Sums of whole numbers by place."""
    total = np.zeros(size, np.int64)
    np.add.at(total, places, n)
    return total


_PLACES: dict[int, np.ndarray] = {}


def _places(rows: np.ndarray, width: int) -> np.ndarray:
    """Where the values of the rows, inputs, stand in a flat array of that many columns."""
    if width not in _PLACES:
        _PLACES[width] = np.arange((CLASSES + 1) * width).reshape(-1, width)
    return _PLACES[width].take(rows, axis=0).ravel()


def _by_row(places: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums of the values' rows, whose `_places` are given."""
    width = values.shape[-1]
    return np.bincount(places, values.ravel(), size * width).reshape(size, width).astype(np.float32)


def _below(x: np.ndarray, row: np.ndarray | float = 0) -> np.ndarray:
    """`x` with a row more, for the 1 at the end of each state."""
    return np.concatenate([x, np.broadcast_to(np.float32(row), (*x.shape[:-2], 1, x.shape[-1]))], axis=-2)


def _beside(x: np.ndarray, value: float = 0) -> np.ndarray:
    """`x` with a column more."""
    return np.concatenate([x, np.full((len(x), 1), value, np.float32)], axis=1)


class AttentionModel:
    """`vocabulary`: number of ids. `arrange` puts the ids into classes, `prepare` takes the counts of all
    learnt texts, and `fit` trains the network; `score` does the same with sums over parts of the texts."""

    def __init__(self, vocabulary: int, seed: int = 2):
        self.vocabulary, self.seed = vocabulary, seed
        #: A bound of all attention scores once training is over; small ones need no shift before exp.
        self.largest: float | None = None

    def arrange(self, ids: np.ndarray) -> None:
        """Classes and groups: who stands beside whom. Any arrangement gives chances that add up to 1."""
        pairs = np.unique(self.pairs(ids, np.array([0, len(ids)])), return_counts=True)
        self.rank(self.counts(*pairs))
        self.gather(self.around(*pairs))
        self.group(self.beside(*pairs))

    def pairs(self, ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Each id with the one before it as one number; `vocabulary` stands before a text's first."""
        before = np.full(len(ids), self.vocabulary, _U)
        before[1:] = ids[:-1]
        before[rows[:-1][np.diff(rows) > 0]] = self.vocabulary
        return before * _U(self.vocabulary + 1) + ids.astype(_U)

    def _split(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        before, after = np.divmod(pairs, _U(self.vocabulary + 1))
        return before.astype(np.int64), after.astype(np.int64)

    # `counts`, `around` and `beside` take distinct pairs and their counts; arrays of several parts of them add up.

    def counts(self, pairs: np.ndarray, n: np.ndarray) -> np.ndarray:
        return _bins(self._split(pairs)[1], n, self.vocabulary)

    def rank(self, count: np.ndarray) -> None:
        self.count = count
        order = np.argsort(-count, kind="stable")
        self.frequent, self.rest = order[:NEIGHBOURS], order[OWN:][count[order[OWN:]] > 0]
        self.own = np.full(self.vocabulary, OWN)
        self.own[order[:OWN]] = np.arange(len(order[:OWN]))

    def around(self, pairs: np.ndarray, n: np.ndarray) -> np.ndarray:
        """How often each frequent id stands before and after each id that has no class of its own."""
        own = np.full(self.vocabulary, NEIGHBOURS)
        own[self.frequent] = np.arange(len(self.frequent))
        place = np.full(self.vocabulary, -1)
        place[self.rest] = np.arange(len(self.rest))
        before, after = self._split(pairs)
        inner, width = before < self.vocabulary, 2 * (NEIGHBOURS + 1)
        total = np.zeros(len(self.rest) * width, np.int64)
        for here, there, side in ((after, before, 0), (before, after, NEIGHBOURS + 1)):
            use = np.flatnonzero(inner)
            use = use[place[here[use]] >= 0]
            total += _bins(place[here[use]] * width + own[there[use]] + side, n[use], len(total))
        return total

    def gather(self, around: np.ndarray) -> None:
        """A class for each id that has none of its own: spherical k-means of the frequent ids that stand around it."""
        if not len(self.rest):
            return
        seen = around.reshape(len(self.rest), -1)
        weight = seen.sum(1)
        x = np.sqrt(seen / np.maximum(weight, 1)[:, None]).astype(np.float32)  # rows of length sqrt(2) at most
        centre = x[np.argsort(-weight, kind="stable")[: CLASSES - OWN]].copy()
        for _ in range(12):
            group = np.argmax(x @ centre.T, axis=1)
            total = np.zeros_like(centre)
            np.add.at(total, group, x * weight[:, None].astype(np.float32))
            centre = total / np.maximum(np.sqrt((total * total).sum(1, keepdims=True)), 1e-9)
        self.own[self.rest] = OWN + np.argmax(x @ centre.T, axis=1)

    def beside(self, pairs: np.ndarray, n: np.ndarray) -> np.ndarray:
        """How often each class stands after each class, or first (row 0)."""
        before, after = self._split(pairs)
        return _bins(np.append(self.own + 1, 0)[before] * CLASSES + self.own[after], n, (CLASSES + 1) * CLASSES)

    def group(self, beside: np.ndarray) -> np.ndarray:
        """Groups of classes, and the tally for `prepare`."""
        beside = beside.reshape(CLASSES + 1, CLASSES)
        features = np.concatenate([np.sqrt(x / np.maximum(x.sum(1, keepdims=True), 1)) for x in (beside[1:], beside[1:].T)], axis=1).astype(np.float32)
        members = np.concatenate(_halves(features, np.arange(CLASSES), MEMBERS))
        place = np.empty(CLASSES, np.int64)
        place[members] = np.arange(CLASSES)
        self.target = place[self.own].astype(np.int16)  # group * MEMBERS + member
        return np.concatenate([beside[np.append(0, members + 1)][:, members].ravel(), self.count])

    def inputs(self, ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """What each id is predicted after: the class before it plus 1, or 0 at a text's start."""
        out = np.zeros(len(ids), np.int32)
        out[1:] = self.target[ids[:-1]] + 1
        out[rows[:-1][np.diff(rows) > 0]] = 0
        return out

    def tally(self, ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Counts of (input, class) pairs, then of ids, as one array; arrays of several texts add up."""
        pairs = np.bincount(self.inputs(ids, rows) * CLASSES + self.target[ids], minlength=(CLASSES + 1) * CLASSES)
        return np.concatenate([pairs, np.bincount(ids, minlength=self.vocabulary)])

    def prepare(self, tally: np.ndarray) -> None:
        """Shares and neighbour tables from the tally of all learnt texts, and a network that knows nothing yet."""
        n = (CLASSES + 1) * CLASSES
        pairs, count = tally[:n].reshape(-1, GROUPS, MEMBERS).astype(np.float64), tally[n:]
        smooth = count + 0.05
        within = np.bincount(self.target, smooth, CLASSES)
        self.share = np.log(smooth / within[self.target]).astype(np.float32)
        held = (np.bincount(self.target, minlength=CLASSES) > 0).reshape(GROUPS, MEMBERS)
        plain = (within * held.ravel()).reshape(GROUPS, MEMBERS)
        by_group = plain.sum(1)
        of_group = pairs.sum(2)
        with np.errstate(divide="ignore", invalid="ignore"):
            pair = np.log(of_group + PAIR_PRIOR[0] * by_group / by_group.sum()) - np.log(of_group.sum(1, keepdims=True) + PAIR_PRIOR[0])
            inner = np.log(pairs + PAIR_PRIOR[1] * plain / by_group[:, None]) - np.log(of_group[:, :, None] + PAIR_PRIOR[1])
        r = np.random.default_rng(self.seed)
        shapes = {"e": (CLASSES + 1, WIDTH), "q": (WIDTH, WIDTH), "k": (WIDTH, WIDTH), "v": (WIDTH, WIDTH), "w1": (WIDTH, HIDDEN), "w2": (HIDDEN, WIDTH), "out": (WIDTH, GROUPS), "member": (GROUPS, WIDTH, MEMBERS)}
        self.p = {k: r.normal(0, 0.5 if k == "e" else 0.3 / np.sqrt(s[0] / 16) if len(s) == 2 else 0.3, s).astype(np.float32) for k, s in shapes.items()}
        self.p |= {"out": self.p["out"] * 0.1, "member": self.p["member"] * 0.1, "b1": np.zeros(HIDDEN, np.float32), "pos": np.zeros(WINDOW, np.float32)}
        self.p["pair"] = np.where(held.any(1), pair, -1e4).astype(np.float32)  # no id is in an empty group or class
        self.inner = np.where(held, inner, -1e4).astype(np.float32)

    def windows(self, ids: np.ndarray, rows: np.ndarray, lead: np.ndarray | int = 0):
        """Inputs (windows x WINDOW, -1 before a text), and for each window the flat places it predicts (-1 past the end).

        `lead`: ids at a row's beginning that are only looked back at, 0 where the text begins with the row.
        """
        lead = np.broadcast_to(lead, len(rows) - 1)
        n, begins, rows = np.diff(rows) - lead, rows, rows[:-1] + lead
        count = -(-n // STRIDE)
        row = np.repeat(np.arange(len(n)), count)
        first = (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)) * STRIDE
        at = first[:, None] + np.arange(-CONTEXT, STRIDE)
        source = self.inputs(ids, begins)
        flat = np.clip(rows[row][:, None] + at, 0, max(len(ids) - 1, 0))
        x = np.where((at >= -lead[row][:, None]) & (at < n[row][:, None]), source[flat] if len(ids) else 0, np.where(at < 0, -1, 0))
        goal = np.where(at[:, CONTEXT:] < n[row][:, None], rows[row][:, None] + at[:, CONTEXT:], -1)
        return x, goal

    _AGO = CONTEXT + np.arange(STRIDE)[:, None] - np.arange(WINDOW)[None, :]

    def scores(self, state: np.ndarray, source: np.ndarray, group: np.ndarray, out: np.ndarray, members: np.ndarray):
        """Scores of all groups, and of the classes of the given group in ascending order of it: their order, the states in it and each group's range."""
        z = state @ out
        z += self.p["pair"].take(source, axis=0)
        order = np.argsort(group, kind="stable")
        cut = np.searchsorted(group[order], np.arange(GROUPS + 1))
        sorted_, y = state.take(order, axis=0), np.empty_like(z)
        for k in np.flatnonzero(np.diff(cut)):
            np.matmul(sorted_[cut[k] : cut[k + 1]], members[k], out=y[cut[k] : cut[k + 1]])
        y += self.inner.reshape(-1, MEMBERS).take((source.astype(np.int64) * GROUPS + group)[order], axis=0)
        return z, y, order, sorted_, cut

    def fixed(self) -> tuple[np.ndarray, ...]:
        """Tables by input: keys, queries, values with a 1 for the sum of weights, and embeddings with a 0; and each place's bias."""
        p = self.p
        bias = np.where(self._AGO >= 0, p["pos"][np.maximum(self._AGO, 0)], np.float32(-1e9))
        return p["e"] @ p["k"], p["e"] @ p["q"] * np.float32(WIDTH**-0.5), _beside(p["e"] @ p["v"], 1), _beside(p["e"]), bias

    def attend(self, x: np.ndarray, tables: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
        """Keys, queries and values of the windows, the weights of attention, 1 by their sums, the means of values and the sums with embeddings, both with a 1 at the end."""
        keys, queries, values, embedded, bias = tables
        source = np.maximum(x, 0)
        k, v, q = keys.take(source, axis=0), values.take(source, axis=0), queries.take(source[:, CONTEXT:], axis=0)
        s = q @ k.transpose(0, 2, 1)
        s += bias
        if len(first := np.flatnonzero(x[:, 0] < 0)):
            s[first] += np.where(x[first] < 0, np.float32(-1e9), np.float32(0))[:, None, :]
        if self.largest is None or self.largest > 60:
            s -= s.max(-1, keepdims=True)
        np.exp(s, out=s)
        mean = (s @ v).reshape(-1, WIDTH + 1)
        parts = 1 / mean[:, WIDTH:]
        mean *= parts
        return k, q, v, s, parts, mean, mean + embedded.take(source[:, CONTEXT:].ravel(), axis=0)

    def layers(self) -> tuple[np.ndarray, ...]:
        """Weights between states that end with a 1: to the hidden layer and back, to groups, and to each group's classes."""
        p = self.p
        return _below(p["w1"], p["b1"]), _beside(p["w2"]), _below(p["out"]), _below(p["member"])

    def log_chances(self, ids: np.ndarray, rows: np.ndarray, batch: int = 128) -> np.ndarray:
        """The natural logarithm of each id's chance, given what stands before it."""
        ones = {n: np.ones(n, np.float32) for n in (GROUPS, MEMBERS)}

        def picked(z: np.ndarray, at: np.ndarray) -> np.ndarray:
            if z.max(initial=0) > 60:  # float32 holds the sum of exponentials up to here
                z -= z.max(-1, keepdims=True)
            own = z[np.arange(len(z)), at]
            np.exp(z, out=z)
            return own - np.log(z @ ones[z.shape[1]])

        x, goal = self.windows(ids, rows)
        out = np.zeros(len(ids) + 1, np.float32)  # places past a text's end, -1, fall behind the last
        classes, tables, (w1, w2, *last) = self.target[ids], self.fixed(), self.layers()
        for a in range(0, len(x), batch):
            own = x[a : a + batch]
            state = self.attend(own, tables)[-1]
            r = state @ w1
            state += np.maximum(r, 0, out=r) @ w2
            at = goal[a : a + batch].reshape(-1)
            target = classes[at]
            group = target // MEMBERS
            z, y, order, _, _ = self.scores(state, own[:, CONTEXT:].reshape(-1), group, *last)
            out[at] = picked(z, group)
            out[at[order]] += picked(y, target[order] % MEMBERS)
        return out[:-1] + self.share[ids]

    def fit(self, ids: np.ndarray, rows: np.ndarray, steps: int) -> None:
        """Training on windows drawn at random."""
        x, goal = self.targets(ids, rows)
        r = np.random.default_rng(self.seed)
        self.learn(x, goal, ((r.integers(0, len(x), BATCH), step / (steps + 1)) for step in range(1, steps + 1)))

    def targets(self, ids: np.ndarray, rows: np.ndarray, lead: np.ndarray | int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Inputs of all windows, and the classes they predict (-1 past the end)."""
        x, goal = self.windows(ids, rows, lead)
        return x.astype(np.int16), np.where(goal >= 0, self.target[ids[np.maximum(goal, 0)]] if len(ids) else 0, -1).astype(np.int16)

    def learn(self, x: np.ndarray, goal: np.ndarray, picks) -> None:
        """Adam on the cross-entropy of groups and of classes within the right group; `picks` gives each step's windows and how much of the training lies behind it."""
        p = self.p
        m = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in p.items()}
        for step, (pick, done) in enumerate(picks, 1):
            rate = 0.01 * min(1, 2 * (1 - done))
            for name, d in self.gradient(x[pick], goal[pick]).items():
                a, b = m[name]
                a += np.float32(0.1) * (d - a)
                d *= d
                b += np.float32(0.01) * (d - b)
                p[name] -= np.float32(rate / (1 - 0.9**step)) * a / (np.sqrt(b * np.float32(1 / (1 - 0.99**step))) + np.float32(1e-8))
        self.bound(*self.fixed()[:2])

    def bound(self, keys: np.ndarray, queries: np.ndarray) -> None:
        norm = lambda x: float(np.sqrt((x * x).sum(1)).max())
        self.largest = norm(keys) * norm(queries) + float(np.abs(self.p["pos"]).max())

    def gradient(self, x: np.ndarray, goal: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy over the windows' places. Keys, values and queries depend on the input alone, so their gradients are gathered by input first."""
        p, tables = self.p, self.fixed()
        self.bound(*tables[:2])
        keys, queries, values, s, parts, mean, h = self.attend(x, tables)
        w1, w2, out, members = self.layers()
        r = h @ w1
        state = np.maximum(r, 0, out=r) @ w2
        state += h

        goal, source = goal.reshape(-1), np.maximum(x, 0)
        used, last = goal >= 0, source[:, CONTEXT:].reshape(-1)
        target, weight = np.where(used, goal, 0), used * np.float32(1 / used.sum())  # places past the end weigh nothing
        group = target // MEMBERS
        z, y, order, sorted_, cut = self.scores(state, last, group, out, members)
        for w, at, own in ((z, group, weight), (y, target[order] % MEMBERS, weight[order])):
            if w.max(initial=0) > 60:
                w -= w.max(-1, keepdims=True)
            np.exp(w, out=w)
            w *= (own / (w @ np.ones(w.shape[1], np.float32)))[:, None]
            w[np.arange(len(w)), at] -= own
        by_group = _places(last, GROUPS)
        by_pair = by_group if GROUPS == 2 * WIDTH else _places(last, 2 * WIDTH)
        grad = {"out": (state.T @ z)[:WIDTH], "pair": _by_row(by_group, z, CLASSES + 1), "member": np.zeros_like(p["member"])}
        inner, back = np.empty_like(state), np.empty_like(order)
        for j in np.flatnonzero(np.diff(cut)):
            a, b = cut[j], cut[j + 1]
            grad["member"][j] = (sorted_[a:b].T @ y[a:b])[:WIDTH]
            np.matmul(y[a:b], members[j].T, out=inner[a:b])
        back[order] = np.arange(len(order))
        d = z @ out.T
        d += inner.take(back, axis=0)
        dr = d @ w2.T
        dr *= r > 0
        d1 = h.T @ dr
        grad["w2"], grad["w1"], grad["b1"] = (r.T @ d)[:, :WIDTH], d1[:WIDTH], d1[WIDTH]
        d += dr @ _below(p["w1"]).T
        part = d * parts
        part[:, WIDTH] = -np.einsum("ij,ij->i", part, mean)
        part = part.reshape(len(x), STRIDE, WIDTH + 1)
        ds = part @ values.transpose(0, 2, 1)
        ds *= s
        grad["pos"] = np.bincount(np.maximum(self._AGO, 0).ravel(), (ds.sum(0) * (self._AGO >= 0)).ravel(), WINDOW).astype(np.float32)
        near, own = np.empty((len(x), WINDOW, 2 * WIDTH), np.float32), np.empty((len(x), STRIDE, 2 * WIDTH), np.float32)
        np.matmul(ds.transpose(0, 2, 1), queries, out=near[:, :, :WIDTH])
        np.matmul(s.transpose(0, 2, 1), part[:, :, :WIDTH], out=near[:, :, WIDTH:])
        np.matmul(ds, keys, out=own[:, :, :WIDTH])
        own.reshape(-1, 2 * WIDTH)[:, WIDTH:] = d[:, :WIDTH]
        near, own = _by_row(_places(source.reshape(-1), 2 * WIDTH), near, CLASSES + 1), _by_row(by_pair, own, CLASSES + 1)
        dk, dv, dq = near[:, :WIDTH], near[:, WIDTH:], own[:, :WIDTH] * np.float32(WIDTH**-0.5)
        grad["k"], grad["v"], grad["q"] = (p["e"].T @ x for x in (dk, dv, dq))
        grad["e"] = dk @ p["k"].T + dv @ p["v"].T + dq @ p["q"].T + own[:, WIDTH:]
        return grad

    def learn_block(self, block: int, ids: np.ndarray, rows: np.ndarray, lead: np.ndarray, batch: int, times: int, begin: float, end: float) -> tuple[np.ndarray, int]:
        """What a block's windows change in the weights, and their number. Each window is used `times` times."""
        x, goal = self.targets(ids, rows, lead)
        before, r = self.flat(), np.random.default_rng((self.seed, block))
        parts = -(-len(x) // batch)
        picks = (pick for _ in range(times) for pick in np.array_split(r.permutation(len(x)), parts))
        kept, self.p = self.p, {k: v.copy() for k, v in self.p.items()}
        self.learn(x, goal, ((pick, begin + (end - begin) * (k + 1) / (parts * times + 1)) for k, pick in enumerate(picks)))
        change, self.p = self.flat() - before, kept
        return change, len(x)

    def flat(self) -> np.ndarray:
        return np.concatenate([v.ravel() for _, v in sorted(self.p.items())]).astype(np.float64)

    def change(self, by: np.ndarray) -> None:
        at = 0
        for k, v in sorted(self.p.items()):
            self.p[k] = (v + by[at : at + v.size].reshape(v.shape)).astype(np.float32)
            at += v.size
        self.bound(*self.fixed()[:2])


class HeavyWords:
    """Counts of the most frequent words in a table of fixed size; further words of a place stand in a sorted array."""

    SLOTS = 1 << 20

    def __init__(self, words: np.ndarray, counts: np.ndarray):
        place, one = np.unique((words & _U(self.SLOTS - 1)).astype(np.int64), return_index=True)
        self.keys, self.counts = np.zeros(self.SLOTS, _U), np.zeros(self.SLOTS, np.int64)
        self.keys[place], self.counts[place] = words[one], counts[one]
        more = np.setdiff1d(np.arange(len(words)), one, assume_unique=True)
        more = more[np.argsort(words[more], kind="stable")]
        self.more, self.more_counts = words[more], counts[more]
        self.crowded = np.zeros(self.SLOTS, bool)
        self.crowded[(self.more & _U(self.SLOTS - 1)).astype(np.int64)] = True

    def look_up(self, words: np.ndarray) -> np.ndarray:
        """Counts, 0 for words that are not held."""
        place = (words & _U(self.SLOTS - 1)).astype(np.int64)
        held = self.keys[place] == words
        found = np.where(held, self.counts[place], 0)
        rest = np.flatnonzero(~held & self.crowded[place])
        if len(rest):
            at = np.minimum(np.searchsorted(self.more, words[rest]), len(self.more) - 1)
            found[rest] = np.where(self.more[at] == words[rest], self.more_counts[at], 0)
        return found


def mixed_log(counts: np.ndarray, total: int, logs: np.ndarray) -> np.ndarray:
    """log10 of words' chances, from their counts among `total` and the model's logarithms. A chance of any smallness keeps its logarithm."""
    with np.errstate(divide="ignore"):
        share = np.log(MIXED * counts / max(total, 1))
    return np.logaddexp(share, np.log(1 - MIXED) + logs) / np.log(10)


def _batch_words(batch: pa.RecordBatch, column: int):
    data, offsets = text_buffer(batch.column(column))
    for i, j in row_blocks(offsets):
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]


_COUNTS = "bucket int, words binary, counts binary"


def _count(path: str, end_id: int, vocabulary: int, buckets: int, blocks: int):
    """Words' counts by bucket; the counts of pairs of ids, in buckets below 0; and the texts' ids by block, in buckets from `buckets` on."""

    def run(batches):
        coder, model = tokenizer(path, "word"), AttentionModel(vocabulary)
        for batch in batches:
            parts, counts, pairs, pair_counts, pieces = [np.full(1, END_WORD)], [np.full(1, len(batch), np.int64)], [], [], []
            for i, j, data, offsets in _batch_words(batch, 0):
                words, n = np.unique(word_hashes(data, offsets)[0], return_counts=True)
                parts.append(words)
                counts.append(n)
                ids, rows = with_end(*coder.encode(data, offsets), end_id)
                keys, n = np.unique(model.pairs(ids, rows), return_counts=True)
                pairs.append(keys)
                pair_counts.append(n)
                pieces.append((ids.astype(_narrow(vocabulary)), *_pieces(rows, batch.column(1).slice(i, j - i).to_numpy().view(_U))))
            if len(batch):
                yield _count_rows([*_by_bucket(parts, counts, buckets, lambda k: k), *_by_bucket(pairs, pair_counts, buckets, lambda k: -1 - k), *_by_block(pieces, buckets, blocks)])

    return run


def _narrow(vocabulary: int):
    return np.uint16 if vocabulary <= 1 << 16 else np.uint32


def _by_bucket(keys: list[np.ndarray], counts: list[np.ndarray], buckets: int, name):
    keys, n = _summed(np.concatenate(keys), np.concatenate(counts))
    place = (mix(keys) % _U(buckets)).astype(np.int64)
    order = np.argsort(place, kind="stable")
    own, cut = np.unique(place[order], return_index=True)
    for k, a, b in zip(own.tolist(), cut, [*cut[1:], len(order)], strict=True):
        yield name(k), keys[order[a:b]].tobytes(), n[order[a:b]].tobytes()


def _pieces(rows: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, leads and names of pieces of at most TOGETHER ids, and what they look back at."""
    n = np.diff(rows)
    count = -(-n // TOGETHER)
    row = np.repeat(np.arange(len(n)), count)
    number = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    lead = np.where(number > 0, LEAD, 0)
    return rows[row] + number * TOGETHER - lead, np.minimum(rows[row] + (number + 1) * TOGETHER, rows[row + 1]), lead, mix(names[row] + number.astype(_U) * END_WORD)


def _by_block(pieces: list[tuple], buckets: int, blocks: int):
    """A row for each block: ids one piece after another, and names, lengths and leads of the pieces."""
    base = np.cumsum([0, *(len(p[0]) for p in pieces)])[:-1]
    ids = np.concatenate([p[0] for p in pieces])
    starts, ends = (np.concatenate([p[k] + b for p, b in zip(pieces, base, strict=True)]) for k in (1, 2))
    leads, names = (np.concatenate([p[k] for p in pieces]) for k in (3, 4))
    block = (names % _U(blocks)).astype(np.int64)
    order = np.argsort(block, kind="stable")
    own, cut = np.unique(block[order], return_index=True)
    for k, a, b in zip(own.tolist(), cut, [*cut[1:], len(order)], strict=True):
        at = order[a:b]
        size = ends[at] - starts[at]
        yield buckets + k, ids[expand(starts[at], size)].tobytes(), np.stack([names[at].view(np.int64), size, leads[at]]).T.tobytes()


def _count_rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[k] for r in rows], pa.binary()) for k in (1, 2))], ["bucket", "words", "counts"])


def _summed(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(words, kind="stable")
    words, counts = words[order], counts[order]
    new = np.flatnonzero(np.diff(words, prepend=words[:1] ^ _U(1)))
    return words[new], np.add.reduceat(counts, new)


def _column(group: pa.Table, name: str, kind) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *(np.frombuffer(x.as_buffer(), kind) for x in group.column(name) if x.is_valid)])


def _sum_bucket(buckets: int, narrow):
    """One row for each bucket: the sums of its words or pairs, or a block's pieces in the order of their names."""

    def run(group: pa.Table) -> pa.Table:
        bucket = group.column("bucket").slice(0, 1)
        if bucket[0].as_py() >= buckets:
            ids, pieces = _column(group, "words", narrow), _column(group, "counts", np.int64).reshape(-1, 3)
            order = np.argsort(pieces[:, 0], kind="stable")
            starts = np.cumsum(pieces[:, 1]) - pieces[:, 1]
            keys, counts, sums = ids[expand(starts[order], pieces[order, 1])], pieces[order, 1:], (None, None)
        else:
            keys, counts = _summed(_column(group, "words", _U), _column(group, "counts", np.int64))
            sums = len(keys), int(counts.sum())
        return pa.table([bucket, pa.array([keys.tobytes()], pa.binary()), pa.array([counts.tobytes()], pa.binary()), *(pa.array([x], pa.int64()) for x in sums)], ["bucket", "words", "counts", "kinds", "total"])

    return run


def _pair_pieces(shared, name: str):
    """What the model's method `name` makes of the pairs, in pieces."""

    def run(batches):
        total = None
        for batch in batches:
            for pairs, n in zip(batch.column(0), batch.column(1), strict=True):
                own = getattr(shared.value, name)(np.frombuffer(pairs.as_buffer(), _U), np.frombuffer(n.as_buffer(), np.int64))
                total = own if total is None else np.add(total, own, out=total)
        if total is not None:
            yield _piece_rows(total)

    return run


def _piece_rows(total: np.ndarray) -> pa.RecordBatch:
    rows = [(k // PIECE, total[k : k + PIECE].tobytes()) for k in range(0, len(total), PIECE) if total[k : k + PIECE].any()]
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["piece", "counts"])


def _learn(shared, narrow, batch: int, times: int, begin: float, end: float):
    """The changes that blocks make in the weights, times their windows, and the windows' number, as whole numbers in pieces."""

    def run(batches):
        total = None
        for rows in batches:
            for block, ids, pieces in zip(rows.column(0).to_pylist(), rows.column(1), rows.column(2), strict=True):
                pieces = np.frombuffer(pieces.as_buffer(), np.int64).reshape(-1, 2)
                change, n = shared.value.learn_block(block, np.frombuffer(ids.as_buffer(), narrow), np.append(0, np.cumsum(pieces[:, 0])), pieces[:, 1], batch, times, begin, end)
                own = np.append(np.rint(change * UNIT).astype(np.int64) * n, n)
                total = own if total is None else total + own
        if total is not None:
            yield _piece_rows(total)

    return run


def _all_pieces(parts: DataFrame, size: int, key=None) -> np.ndarray:
    """The sum of all tasks' arrays; pieces are added up in tasks of their own."""
    total = np.zeros(size, np.int64)
    for k, x in parts.repartition("piece").mapInArrow(lean(_sum_pieces, key), "piece int, counts binary").collect():
        total[k * PIECE : (k + 1) * PIECE] = np.frombuffer(x, np.int64)
    return total


def _sum_pieces(batches):
    """One array for each piece; a task holds its own pieces only."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            own = np.frombuffer(x.as_buffer(), np.int64)
            total[k] = total[k] + own if k in total else own
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["piece", "counts"])


def _frequent(least: int):
    def run(batches):
        for batch in batches:
            for words, counts in zip(batch.column(0), batch.column(1), strict=True):
                words, counts = np.frombuffer(words.as_buffer(), _U), np.frombuffer(counts.as_buffer(), np.int64)
                keep = (counts >= least) | (words == END_WORD)
                yield pa.RecordBatch.from_arrays([pa.array([words[keep].tobytes()], pa.binary()), pa.array([counts[keep].tobytes()], pa.binary())], ["words", "counts"])

    return run


#: docs: local places (unsigned 32-bit). A row of bucket words has words, docs and the logarithms of the model's chances; a row of documents has doc_ids and the arrays after it.
_SCORED = "bucket int, batch long, words binary, docs binary, chances binary, doc_ids array<long>, n_tokens binary, known binary, logs binary, scores binary"


def _score(shared, path: str, end_id: int, buckets: int, total: int):
    def run(batches):
        from pyspark import TaskContext

        model, heavy = shared.value
        coder, number = tokenizer(path, "word"), TaskContext.get().partitionId() << 32
        schema = pa.schema([("bucket", pa.int32()), ("batch", pa.int64()), ("words", pa.binary()), ("docs", pa.binary()), ("chances", pa.binary()), ("doc_ids", pa.list_(pa.int64())), *((k, pa.binary()) for k in ("n_tokens", "known", "logs", "scores"))])
        for batch in batches:
            n = len(batch)
            tokens, known, logs, scores = np.ones(n, np.int64), np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
            cold, local, apart = [], [], []
            for i, j, data, offsets in _batch_words(batch, 1):
                ids, size, rows = coder.encode_segments(data, offsets)
                words, _ = word_hashes(data, offsets)
                # the end stands after each text's words, as a word of one id
                count = np.diff(rows)
                last = rows[1:] + np.arange(len(count))
                inner = np.ones(len(words) + len(count), bool)
                inner[last] = False
                every, sizes = np.full(len(inner), END_WORD), np.ones(len(inner), np.int64)
                every[inner], sizes[inner] = words, size
                row = np.repeat(np.arange(len(count)), count + 1)
                bounds = np.concatenate([[0], np.cumsum(size)])[rows]
                all_ids, all_rows = with_end(ids, bounds, end_id)
                chance = np.concatenate([[0.0], np.cumsum(model.log_chances(all_ids, all_rows), dtype=np.float64)])
                at = np.concatenate([[0], np.cumsum(sizes)])
                c = heavy.look_up(every)
                word_log = chance[at[1:]] - chance[at[:-1]]
                tokens[i:j] = count + 1
                hit = c > 0
                scores[i:j] = np.bincount(row[hit], mixed_log(c[hit], total, word_log[hit]), j - i)
                known[i:j] = np.bincount(row[hit], minlength=j - i)
                logs[i:j] = np.bincount(row[hit], np.log10(c[hit] + 1.0), j - i)
                cold.append(every[~hit])
                local.append((row[~hit] + i).astype(np.uint32))
                apart.append(word_log[~hit])
            if not n:
                continue
            words, docs = np.concatenate([np.zeros(0, _U), *cold]), np.concatenate([np.zeros(0, np.uint32), *local])
            chances = np.concatenate([np.zeros(0), *apart])
            place = (mix(words) % _U(buckets)).astype(np.int64)
            order = np.argsort(place, kind="stable")
            cut = np.searchsorted(place[order], np.arange(buckets + 1))
            rows = [(k, number, words[order[a:b]].tobytes(), docs[order[a:b]].tobytes(), chances[order[a:b]].tobytes(), None, None, None, None, None) for k, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if b > a]
            rows.append((int(mix(np.full(1, number, _U))[0] % _U(buckets)), number, None, None, None, batch.column(0).to_pylist(), *(x.tobytes() for x in (tokens, known, logs, scores))))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)
            number += 1

    return run


_PARTIAL = "batch long, docs binary, doc_ids array<long>, n_tokens binary, known binary, logs binary, scores binary"


def _look_up(total: int):
    """Counts for a bucket's words, and their mixed chances, summed for each document of each batch; rows of documents pass."""

    def run(group: pa.Table) -> pa.Table:
        held = group.column("counts").is_valid().to_numpy()
        table = group.filter(pa.array(held))
        words, counts = _column(table, "words", _U), _column(table, "counts", np.int64)
        out = []
        for r in group.filter(pa.array(~held)).select(["batch", "words", "docs", "chances", "doc_ids", "n_tokens", "known", "logs", "scores"]).to_pylist():
            if r["doc_ids"] is None:
                own, docs, chances = np.frombuffer(r["words"], _U), np.frombuffer(r["docs"], np.uint32), np.frombuffer(r["chances"], np.float64)
                at = np.minimum(np.searchsorted(words, own), max(len(words) - 1, 0))
                c = np.where(words[at] == own, counts[at], 0) if len(words) else np.zeros(len(own), np.int64)
                docs, back = np.unique(docs, return_inverse=True)
                sums = (np.bincount(back, x, len(docs)) for x in (np.log10(c + 1.0), mixed_log(c, total, chances)))
                r |= {"docs": docs.tobytes(), "known": np.bincount(back, c > 0, len(docs)).astype(np.int64).tobytes(), **{k: x.tobytes() for k, x in zip(("logs", "scores"), sums, strict=True)}}
            del r["words"], r["chances"]
            out.append(r)
        return pa.Table.from_pylist(out, schema=pa.schema([("batch", pa.int64()), ("docs", pa.binary()), ("doc_ids", pa.list_(pa.int64())), *((k, pa.binary()) for k in ("n_tokens", "known", "logs", "scores"))]))

    return run


def _finish(total: int, kinds: int):
    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        main = next(r for r in rows if r["doc_ids"] is not None)
        tokens, known, logs = np.frombuffer(main["n_tokens"], np.int64), np.frombuffer(main["known"], np.int64).copy(), np.frombuffer(main["logs"], np.float64).copy()
        scores = np.frombuffer(main["scores"], np.float64).copy()
        for r in rows:
            if r["doc_ids"] is None:
                docs = np.frombuffer(r["docs"], np.uint32)
                known[docs] += np.frombuffer(r["known"], np.int64)
                logs[docs] += np.frombuffer(r["logs"], np.float64)
                scores[docs] += np.frombuffer(r["scores"], np.float64)
        base = logs - tokens * np.log10(total + kinds + 1.0)
        return pa.table([pa.array(main["doc_ids"], pa.int64()), pa.array(tokens), pa.array(known), pa.array(np.full(len(tokens), total)), pa.array(base), pa.array(scores)], ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def train(counts: DataFrame, vocabulary: int, buckets: int, blocks: int, key=None, seed: int = 2) -> AttentionModel:
    """A model of all texts behind `counts`, the table that `gathered` gives; `learnt` is the number of their windows. Workers keep what has this key."""
    context, model = counts.sparkSession.sparkContext, AttentionModel(vocabulary, seed)

    def added(rows: DataFrame, run, size: int) -> np.ndarray:
        shared = context.broadcast(model)
        total = _all_pieces(rows.mapInArrow(lean(run(shared), key), "piece int, counts binary"), size, key)
        shared.destroy()
        return total

    pairs = counts.where("bucket < 0").select("words", "counts")
    of_pairs = lambda name, size: added(pairs, lambda shared: _pair_pieces(shared, name), size)
    model.rank(of_pairs("counts", vocabulary))
    model.gather(of_pairs("around", len(model.rest) * 2 * (NEIGHBOURS + 1)))
    model.prepare(model.group(of_pairs("beside", (CLASSES + 1) * CLASSES)))
    batch = int(np.clip(model.count.sum() // (STRIDE * STEPS), BATCH, LARGE_BATCH))
    times = max(1, -(-STEPS * BATCH * STRIDE // max(int(model.count.sum()), 1)))
    rounds = min(ROUNDS, blocks)
    model.learnt, size = 0, len(model.flat())
    for k in range(rounds):
        block = F.col("bucket") - buckets
        rows = counts.where((block >= 0) & (block % rounds == k)).select(block.alias("block"), "words", "counts")
        total = added(rows, lambda shared, k=k: _learn(shared, _narrow(vocabulary), batch, times, k / rounds, (k + 1) / rounds), size + 1)
        model.learnt += int(total[-1])
        if total[-1]:
            model.change(total[:-1] / (float(total[-1]) * UNIT))
    return model


def gathered(docs: DataFrame, learn, path: str, end_id: int, vocabulary: int) -> tuple[DataFrame, int, int]:
    """What `train` and the look-ups take from all rows of (doc_id, text) where `learn` holds, with its numbers of buckets and blocks."""
    key = tokenizer_key(path, "word")  # its memory stays for the second pass over the texts
    buckets = sized(docs, "text", BUCKET_BYTES, 2)
    rows = docs.where(learn)
    blocks = max(1, -(-(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BLOCK_BYTES))
    counted = rows.select("text", F.xxhash64("doc_id", "text").alias("name")).mapInArrow(_count(path, end_id, vocabulary, buckets, blocks), _COUNTS)
    summed = counted.groupBy("bucket").applyInArrow(lean_group(_sum_bucket(buckets, _narrow(vocabulary)), key), f"{_COUNTS}, kinds long, total long")
    return spill(summed, "word-counts"), buckets, blocks


def score(docs: DataFrame, learn, path: str, end_id: int, vocabulary: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of each row; counts are of all rows where `learn` holds.

    Null and empty texts are one end token. Repeated rows count and are scored each by itself; a row
    without an id is scored with a null doc_id. A word of any length has its exact logarithm. Only
    the two named columns are read. An empty table gives an empty result.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    context, key = docs.sparkSession.sparkContext, tokenizer_key(path, "word")
    counts, buckets, blocks = gathered(docs, learn, path, end_id, vocabulary)
    model = train(counts, vocabulary, buckets, blocks, key)

    counts = counts.where((F.col("bucket") >= 0) & (F.col("bucket") < buckets))
    sums = counts.agg(F.sum("kinds").alias("kinds"), F.sum("total").alias("total")).first()
    kinds, total = sums.kinds or 0, sums.total or 0
    least = max(2, -(-total // HEAVY))  # so many words at most are as frequent
    found = counts.select("words", "counts").mapInArrow(lean(_frequent(least), key), "words binary, counts binary").collect()
    heavy = HeavyWords(*(np.concatenate([np.zeros(0, kind), *(np.frombuffer(r[k], kind) for r in found)]) for k, kind in ((0, _U), (1, np.int64))))
    scored = docs.mapInArrow(_score(context.broadcast((model, heavy)), path, end_id, buckets, total), _SCORED)
    both = scored.unionByName(counts.select("bucket", "words", "counts"), allowMissingColumns=True)
    partial = both.groupBy("bucket").applyInArrow(lean_group(_look_up(total)), _PARTIAL)
    return partial.groupBy("batch").applyInArrow(lean_group(_finish(total, kinds)), "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
