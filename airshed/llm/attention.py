"""A small causal self-attention model over subword ids, in numpy: loss, gradients, training and batched scoring.

One block: embeddings of the id, its class and its place, one causal attention head with a residual connection, a ReLU layer
with a residual connection, and a hierarchical softmax: binary decisions from the hidden state lead to the class,
in a complete tree, and on to the id, in a Huffman tree of the class's ids (`Ids`). Without `Ids` the classes are the tokens.
"""

from __future__ import annotations

import heapq

import numpy as np

WIDTH = 16
HIDDEN = 32
CONTEXT = 32  # tokens of a window
STEP = 24  # a window starts so many tokens after the one before; the first CONTEXT - STEP tokens are context only
CLASSES = 64
START = CLASSES  # input class before the first token
RATE = 4e-3  # of a step in the first round
ID_RATE = 0.1  # of a step of single ids' vectors

SHAPES = {
    "embed": (CLASSES + 1, WIDTH), "place": (CONTEXT, WIDTH), "qkv": (WIDTH, 3 * WIDTH), "o": (WIDTH, WIDTH),
    "w1": (WIDTH, HIDDEN), "w2": (HIDDEN, WIDTH), "out": (WIDTH, CLASSES), "bias": (CLASSES,),
}
_ENDS = np.cumsum([int(np.prod(s)) for s in SHAPES.values()]).tolist()
_PARTS = [(name, slice(a, b), shape) for (name, shape), a, b in zip(SHAPES.items(), [0, *_ENDS], _ENDS)]
SIZE = _ENDS[-1]
_SCALE = np.float32(WIDTH ** -0.5)
_SEEN = np.tri(CONTEXT, dtype=np.float32)  # 1 for a place and those before it
_SAFE = 60  # below it exponentials need no shift
_DEPTH = CLASSES.bit_length() - 1  # decisions to a class; the last of `out`'s columns stands for none
_NODES = np.array([[(1 << d) - 1 + (c >> (_DEPTH - d)) for d in range(_DEPTH)] for c in range(CLASSES)])
_SIGNS = np.array([[1 if c >> (_DEPTH - 1 - d) & 1 else -1 for d in range(_DEPTH)] for c in range(CLASSES)], np.float32)
_SURE = 14  # log odds of a decision lie between -_SURE and _SURE, so the odds of _DEPTH decisions have a product


def keep_memory() -> None:
    """Let this process keep what it frees: the C library returns large arrays to the system at once, until one larger than they was freed.

    Without it, mapping and unmapping the arrays of each step takes half of a step's time. And make one square product: until a process
    made one, products of narrow matrices took it up to five times as long (230 instead of 45 ns a row, OpenBLAS 0.3.30).
    """
    np.empty(24 << 20, np.uint8)
    np.ones((64, 64)) @ np.ones((64, 64))


def views(flat: np.ndarray) -> dict[str, np.ndarray]:
    """The model's arrays as views of one flat vector."""
    return {name: flat[part].reshape(shape) for name, part, shape in _PARTS}


def initial(class_shares: np.ndarray, seed: int = 7) -> np.ndarray:
    """Random weights; the bias starts at the log odds of each decision, so that classes begin at their shares."""
    flat = np.random.default_rng(seed).normal(0, 0.15, SIZE).astype(np.float32)
    bias = views(flat)["bias"]
    bias[:] = 0
    for d in range(_DEPTH):
        halves = np.asarray(class_shares).reshape(1 << d, 2, -1).sum(axis=2)
        bias[(1 << d) - 1:(2 << d) - 1] = np.log(halves[:, 1] / halves[:, 0])
    return flat


class Ids:
    """Vectors of single ids: `own` is added to the id's class at the input, `nodes` are the decisions that lead from a class to an id.

    Both begin at zero, where an id has the share `mass` gives it in its class. An id's decisions are those of its class's
    Huffman tree, so frequent ids have few. The input row after the last id stands before the first token.
    """

    def __init__(self, of: np.ndarray, mass: np.ndarray):
        self.of = np.append(of, START)
        self.kind = np.min_scalar_type(len(of))
        children, odds, depth = [], [], []
        order = np.argsort(of, kind="stable")
        for group in np.split(order, np.flatnonzero(np.diff(of[order])) + 1):
            heap = [(float(mass[i]), k, ~int(i)) for k, i in enumerate(group)]  # below zero: an id
            heapq.heapify(heap)
            while len(heap) > 1:
                (a, _, left), (b, k, right) = heapq.heappop(heap), heapq.heappop(heap)
                heapq.heappush(heap, (a + b, len(of) + len(children), len(children)))
                children.append((left, right))
                odds.append(np.log(b / a))
        above: dict[int, list[int]] = {}  # a node's decisions: its parents' numbers, ~number where the left child is taken
        found: list[list[int]] = [[] for _ in range(len(of))]
        for n in range(len(children) - 1, -1, -1):  # parents have larger numbers
            path = above.pop(n, [])
            for child, step in zip(children[n], (~n, n)):
                if child < 0:
                    found[~child] = [*path, step]
                else:
                    above[child] = [*path, step]
        steps = np.array([s for path in found for s in path], np.int32)
        self.lengths = np.array([len(path) for path in found], np.int32)
        self.starts = np.cumsum(self.lengths, dtype=np.int32) - self.lengths
        self.node = np.where(steps < 0, ~steps, steps).astype(np.min_scalar_type(max(1, len(children))))
        self.sign = np.where(steps < 0, -1, 1).astype(np.int8)
        self.odds = np.array(odds, np.float32)
        self.own = np.zeros((len(of) + 1, WIDTH), np.float32)
        self.nodes = np.zeros((len(children), WIDTH), np.float32)

    def copy(self) -> "Ids":
        new = object.__new__(Ids)
        new.__dict__ = {**self.__dict__, "own": self.own.copy(), "nodes": self.nodes.copy()}
        return new

    def decisions(self, targets: np.ndarray):
        """All decisions on the ways to `targets`, the first of all, then the second and so on: the target's place, the node, the sign.

        Also how many targets have a first, a second and so on; targets stand by falling number of decisions, so those are
        the first ones of the same list each time.
        """
        sizes = np.take(self.lengths, targets)
        order = np.argsort(-sizes.astype(np.int16), kind="stable")
        width = (len(sizes) - np.cumsum(np.bincount(sizes, minlength=1)))[:-1].tolist()
        starts = np.take(self.starts, np.take(targets, order))
        if not width:
            return order[:0], self.node[:0], self.sign[:0], width
        at = np.concatenate([starts[:m] + d for d, m in enumerate(width)])
        return np.concatenate([order[:m] for m in width]), np.take(self.node, at), np.take(self.sign, at), width

    def odds_against(self, h: np.ndarray, token: np.ndarray, node: np.ndarray, sign: np.ndarray) -> np.ndarray:
        """Each decision's odds against the way taken."""
        y = np.einsum("ij,ij->i", np.take(h, token, axis=0), np.take(self.nodes, node, axis=0))
        y += np.take(self.odds, node)
        y *= sign
        return _odds(y)


def _heads(qkv: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Queries, keys and values as views: (windows, CONTEXT, WIDTH) each."""
    parts = qkv.reshape(-1, CONTEXT, 3 * WIDTH)
    return parts[:, :, :WIDTH], parts[:, :, WIDTH:2 * WIDTH], parts[:, :, 2 * WIDTH:]


def _attention(a: np.ndarray, seen: np.ndarray) -> None:
    """Exponentials in place, of values less their row's largest where they might overflow; zero where `seen` is."""
    if a.max() > _SAFE:
        a -= 1e9 * (1 - seen)
        a -= a.max(axis=-1, keepdims=True)
        np.exp(a, out=a)
    else:
        np.exp(a, out=a)
        a *= seen


def _forward(p: dict[str, np.ndarray], inputs: np.ndarray, first: int = 0, ids: Ids | None = None):
    """Rows are tokens: all arrays but the attention's are (windows * CONTEXT, ...); after it, those from place `first` on."""
    x = np.take(p["embed"], inputs if ids is None else np.take(ids.of, inputs), axis=0)
    if ids is not None:
        x += np.take(ids.own, inputs, axis=0)
    x += p["place"]
    x = x.reshape(-1, WIDTH)
    qkv = x @ p["qkv"]
    qkv[:, :WIDTH] *= _SCALE
    q, k, v = _heads(qkv)
    a = q[:, first:] @ k.transpose(0, 2, 1)
    _attention(a, _SEEN[first:])
    total = a.reshape(-1, CONTEXT) @ np.ones((CONTEXT, 1), a.dtype)
    mixed = (a @ v).reshape(-1, WIDTH)
    mixed /= total
    z = mixed @ p["o"]
    z += x.reshape(-1, CONTEXT, WIDTH)[:, first:].reshape(-1, WIDTH)
    act = z @ p["w1"]
    np.maximum(act, 0, out=act)
    h = act @ p["w2"]
    h += z
    return x, qkv, a, total, mixed, z, act, h


def _class_odds(p: dict[str, np.ndarray], h: np.ndarray, classes: np.ndarray):
    """Odds against the ways taken to each row's class, (rows, _DEPTH), the decisions' places in rows of CLASSES, and their signs."""
    at, signs = np.take(_NODES, classes, axis=0), np.take(_SIGNS, classes, axis=0)
    at += np.arange(0, len(h) * CLASSES, CLASSES)[:, None]
    logits = h @ p["out"]
    logits += p["bias"]
    y = np.take(logits.reshape(-1), at)
    y *= signs
    return _odds(y), at, signs


def _odds(y: np.ndarray) -> np.ndarray:
    """Odds against ways taken at log odds `y`, in place."""
    np.clip(y, -_SURE, _SURE, out=y)
    return np.exp(np.negative(y, out=y), out=y)


def _class_log_probs(odds: np.ndarray) -> np.ndarray:
    odds += 1
    product = odds[:, 0].copy()
    for d in range(1, _DEPTH):
        product *= odds[:, d]
    return -np.log(product)


def log_probs(p: dict[str, np.ndarray], inputs: np.ndarray, targets: np.ndarray, first: int, ids: Ids | None = None, together: int = 32) -> np.ndarray:
    """Natural log probability of each target from place `first` on; inputs, targets: (windows, CONTEXT).

    So many windows `together` fit a core's cache; decisions inside classes, which are few, are made for all windows at once.
    """
    wanted = targets[:, first:].reshape(-1)
    classes, h, picked = wanted if ids is None else np.take(ids.of, wanted), [], []
    for at in range(0, len(inputs), together):
        h.append(_forward(p, inputs[at:at + together], first, ids)[-1])
        rows = slice(at * (CONTEXT - first), at * (CONTEXT - first) + len(h[-1]))
        picked.append(_class_log_probs(_class_odds(p, h[-1], classes[rows])[0]))
    picked = np.concatenate(picked)
    if ids is not None:
        token, node, sign, width = ids.decisions(wanted)
        log_p = np.log(1 + ids.odds_against(np.concatenate(h), token, node, sign))
        begin = 0
        for m in width:  # in all, as in `_gradients`
            log_p[:m] += log_p[begin:begin + m] if begin else 0
            begin += m
        if width:
            picked[token[:width[0]]] -= log_p[:width[0]]
    return picked.reshape(len(targets), -1)


def _summed(keys: np.ndarray, rows: np.ndarray, at: np.ndarray | None = None, scale: np.ndarray | None = None):
    """Distinct keys, each one's number of rows and the sum of them: of `rows`, or of those at `at`, by `scale`."""
    if not len(keys):
        return keys, np.zeros(0, np.int64), rows[:0]
    order = np.argsort(keys, kind="stable")
    keys = np.take(keys, order)
    begins = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1))
    rows = np.take(rows, order if at is None else np.take(at, order), axis=0)
    if scale is not None:
        rows *= np.take(scale, order)[:, None]
    return keys[begins], np.diff(begins, append=len(keys)), np.add.reduceat(rows, begins, axis=0)


def _gradients(flat: np.ndarray, inputs: np.ndarray, targets: np.ndarray, ids: Ids | None):
    """Odds against all ways taken, the gradient of the mean negative log probability, and for `own` and `nodes`: the
    ids or nodes seen, how often, and the sums of their gradients over tokens.
    """
    p, grad = views(flat), np.zeros_like(flat)
    g = views(grad)
    x, qkv, a, total, mixed, z, act, h = _forward(p, inputs, 0, ids)
    wanted = targets.reshape(-1)
    counted = wanted >= 0
    wanted = np.maximum(wanted, 0)
    n = max(1, int(counted.sum()))
    against, at, signs = _class_odds(p, h, wanted if ids is None else np.take(ids.of, wanted))
    signs *= (counted / -n).astype(h.dtype)[:, None]
    signs *= against / (1 + against)
    d = np.zeros((len(h), CLASSES), h.dtype)
    d.reshape(-1)[at] = signs
    np.matmul(h.T, d, out=g["out"])
    g["bias"][:] = np.ones(len(d), d.dtype) @ d
    dh = d @ p["out"].T
    odds, found = [(against, counted[:, None])], None
    if ids is not None:
        place = np.flatnonzero(counted)
        token, node, sign, width = ids.decisions(np.take(wanted, place))
        token = np.take(place, token)
        against = ids.odds_against(h, token, node, sign)
        odds.append((against, True))
        missed = against / (1 + against)
        missed *= sign  # the log odds' gradient, but for its sign
        found = _summed(node, h, token, -missed)
        if width:
            sums = np.take(ids.nodes, node, axis=0)
            sums *= (missed / -n)[:, None]
            begin = width[0]
            for m in width[1:]:  # the tokens with a second decision, a third and so on are the first ones of the same list
                sums[:m] += sums[begin:begin + m]
                begin += m
            dh[token[:width[0]]] += sums[:width[0]]
    dact = dh @ p["w2"].T
    dact *= act > 0
    np.matmul(act.T, dh, out=g["w2"])
    np.matmul(z.T, dact, out=g["w1"])
    dz = dact @ p["w1"].T
    dz += dh
    np.matmul(mixed.T, dz, out=g["o"])
    dmixed = dz @ p["o"].T
    own = np.einsum("ij,ij->i", dmixed, mixed)  # what each row of weights has in common
    dmixed /= total  # weights are exponentials over their total
    own /= total[:, 0]
    q, k, v = _heads(qkv)
    dmixed = dmixed.reshape(-1, CONTEXT, WIDTH)
    dqkv = np.empty_like(qkv)
    dq, dk, dv = _heads(dqkv)
    dv[:] = a.transpose(0, 2, 1) @ dmixed
    ds = dmixed @ v.transpose(0, 2, 1)
    ds -= own.reshape(-1, CONTEXT, 1)
    ds *= a
    dq[:] = ds @ k
    dk[:] = ds.transpose(0, 2, 1) @ q
    dq *= _SCALE
    np.matmul(x.T, dqkv, out=g["qkv"])
    dx = dqkv @ p["qkv"].T
    dx += dz
    g["place"][:] = dx.reshape(-1, CONTEXT, WIDTH).sum(axis=0)
    seen, often, sums = _summed(inputs.reshape(-1).astype(np.uint16 if ids is None else ids.kind), dx)
    mark = np.zeros((len(seen), CLASSES + 1), dx.dtype)  # one mark a row: sums by input class as a product
    mark[np.arange(len(seen)), seen if ids is None else np.take(ids.of, seen)] = 1
    np.matmul(mark.T, sums, out=g["embed"])
    return odds, grad, n, ids and ((seen, often, sums * n), found)


def loss_and_gradient(flat: np.ndarray, inputs: np.ndarray, targets: np.ndarray, ids: Ids | None = None) -> tuple[float, np.ndarray]:
    """Mean negative log probability and its gradient; a target of -1 doesn't count."""
    odds, grad, n, _ = _gradients(flat, inputs, targets, ids)
    return sum(float((np.log(1 + against) * counted).sum()) for against, counted in odds) / n, grad


class Adam:
    """Steps along averaged gradients; one instance lives through all of a task's blocks."""

    def __init__(self, rate: float = RATE):
        self.rate, self.steps = rate, 0
        self.mean, self.square = np.zeros(SIZE, np.float32), np.zeros(SIZE, np.float32)

    def step(self, flat: np.ndarray, grad: np.ndarray) -> None:
        self.steps += 1
        self.mean += 0.1 * (grad - self.mean)
        self.square += 0.01 * (grad * grad - self.square)
        flat -= self.rate * (self.mean / (1 - 0.9 ** self.steps)) / (np.sqrt(self.square / (1 - 0.99 ** self.steps)) + 1e-8)


class IdSteps:
    """Adagrad, one number a row, for the rows of `own` and `nodes` that a step saw; counts how often each was seen."""

    def __init__(self, ids: Ids, rate: float = ID_RATE):
        self.rate, self.tables = rate, (ids.own, ids.nodes)
        self.squares = [np.ones(len(t), np.float32) for t in self.tables]
        self.seen = [np.zeros(len(t), np.int64) for t in self.tables]

    def step(self, found) -> None:
        for table, squares, seen, (rows, often, grad) in zip(self.tables, self.squares, self.seen, found):
            square = np.take(squares, rows)
            square += np.einsum("ij,ij->i", grad, grad) / WIDTH
            squares[rows] = square
            table[rows] = np.take(table, rows, axis=0) - (self.rate / np.sqrt(square))[:, None] * grad
            seen[rows] += often


def fit(flat: np.ndarray, inputs: np.ndarray, targets: np.ndarray, adam: Adam, ids: Ids | None = None, steps: IdSteps | None = None,
        batch: int = 32) -> np.ndarray:
    """One pass over the windows, in order; changes `ids` in place."""
    flat = flat.copy()
    for at in range(0, len(inputs), batch):
        _, grad, _, found = _gradients(flat, inputs[at:at + batch], targets[at:at + batch], ids)
        adam.step(flat, grad)
        if ids is not None:
            steps.step(found)
    return flat


def window_starts(sizes: np.ndarray, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """For documents of `sizes` tokens: document of each window and the window's first token in it."""
    count = 1 + np.maximum(0, -(-(sizes - CONTEXT) // step))
    doc = np.repeat(np.arange(len(sizes)), count)
    first = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    return doc, first * step


def windows(tokens: np.ndarray, begins: np.ndarray, sizes: np.ndarray, doc: np.ndarray, start: np.ndarray, before: int = START):
    """Inputs, targets and which places hold tokens, for windows of documents that lie one after the other in `tokens`.

    `before`: the input at a document's first token.
    """
    place = start[:, None] + np.arange(CONTEXT)
    there = place < sizes[doc][:, None]
    at = np.where(there, begins[doc][:, None] + place, 0)
    targets = tokens[at]
    inputs = np.empty_like(targets)
    inputs[:, 1:] = targets[:, :-1]
    inputs[:, 0] = np.where(start > 0, tokens[np.maximum(at[:, 0] - 1, 0)], before)
    return inputs, targets, there
