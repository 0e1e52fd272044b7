"""A small gated recurrent language model in numpy: class-factored softmax, truncated backpropagation through time.

A token is an input number (a frequent word, the end, or the class of a rarer word), an output class and, for frequent
words, a place in the class. ``P(token | state) = P(class | state) * P(place | class, state)``; for rarer words the second
factor is a constant of the word that the caller adds.
"""

from __future__ import annotations

import numpy as np

EMBED, STATE = 8, 12
WINDOW = 16  # steps of truncated backpropagation; the state is carried on
LANES = 512  # stretches of text side by side in training
STRETCH = 256  # tokens of a stretch: in training a long text is learnt in several, each from a fresh state
RATE = 0.006
BLOCK = 4096  # tokens whose classes are weighed at once, small enough for a processor's cache
Params = dict[str, np.ndarray]


def start(inputs: int, classes: int, groups: int, places: int, seed: int = 5) -> Params:
    rng = np.random.default_rng(seed)

    def r(*shape):
        return rng.normal(0, 0.1, shape).astype(np.float32)

    return {
        "emb": r(inputs, EMBED), "wx": r(EMBED, 3 * STATE), "b": np.zeros(3 * STATE, np.float32), "wh": r(STATE, 3 * STATE),
        "wc": r(STATE, classes), "bc": np.zeros(classes, np.float32), "wo": r(groups, STATE, places), "bo": np.zeros((groups, places), np.float32),
    }


def pack_params(p: Params) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in sorted(p)])


def unpack_params(flat: np.ndarray, like: Params) -> Params:
    out, at = {}, 0
    for k in sorted(like):
        n = like[k].size
        out[k] = flat[at:at + n].reshape(like[k].shape).astype(np.float32)
        at += n
    return out


class Texts:
    """Input numbers of several documents, longest first; those of step ``t``, of all documents that reach it, stand next to
    each other from ``at[t]`` on. ``outs``: class and place of each input number."""

    def __init__(self, docs: list[np.ndarray], end_input: int, outs: tuple[np.ndarray, np.ndarray]):
        sizes = np.array([len(d) for d in docs])
        self.order = np.argsort(-sizes, kind="stable")
        self.sizes = sizes[self.order]
        self.longest = int(self.sizes[0])
        self.at = np.concatenate([[0], np.cumsum(np.searchsorted(-self.sizes, -np.arange(self.longest), side="left"))])
        self.inputs = np.empty(self.at[-1], np.uint16)
        for i, k in enumerate(self.order.tolist()):
            self.inputs[self.at[:len(docs[k])] + i] = docs[k]
        self.outs, self.end = outs, end_input

    def window(self, t0: int) -> tuple[list[tuple[np.ndarray, int, int]], np.ndarray, np.ndarray]:
        """Of each step of a window the inputs read and (from, to) among its tokens; class and place of its tokens."""
        at = self.at[t0:t0 + WINDOW + 1].tolist()
        first, said = at[0], self.inputs[at[0]:at[-1]]
        before = [int(self.at[t0 - 1]) if t0 else -1, *at[:-2]]
        steps = []
        for was, lo, hi in zip(before, at, at[1:], strict=False):
            ids = np.full(hi - lo, self.end, np.uint16) if was < 0 else self.inputs[was:was + hi - lo]
            steps.append((ids, lo - first, hi - first))
        return steps, self.outs[0][said], self.outs[1][said]


def outputs(p: Params, h: np.ndarray, cls: np.ndarray, place: np.ndarray, learn: bool):
    """Natural log probabilities of (class, place) at states ``h``; with ``learn`` also the gradients."""
    # States lie between -1 and 1, so logits stay far below what exp can take: no maximum is subtracted.
    ll = np.empty(len(h), h.dtype)
    grads = dh = None
    if learn:
        grads = {"wc": np.zeros_like(p["wc"]), "bc": np.zeros_like(p["bc"]), "wo": np.zeros_like(p["wo"]), "bo": np.zeros_like(p["bo"])}
        dh = np.empty_like(h)
    for lo in range(0, len(h), BLOCK):
        hh, c = h[lo:lo + BLOCK], cls[lo:lo + BLOCK]
        part, e = softmax(hh, p["wc"], p["bc"], c, learn)
        ll[lo:lo + BLOCK] = part
        if learn:
            grads["wc"] += hh.T @ e
            grads["bc"] += np.ones(len(e), e.dtype) @ e
            np.matmul(e, p["wc"].T, out=dh[lo:lo + BLOCK])
    head = np.flatnonzero(place >= 0)
    if len(head):
        # Numbers of 16 bits are sorted by their digits, in time in proportion to their count.
        head = head[np.argsort(cls[head].astype(np.uint16), kind="stable")]
        groups, at = np.unique(cls[head], return_index=True)
        states, places = h[head], place[head]
        back, gone = np.empty(len(head), ll.dtype), np.empty_like(states) if learn else None
        for g, lo, hi in zip(groups.tolist(), at.tolist(), [*at[1:].tolist(), len(head)], strict=True):
            hh = states[lo:hi]
            back[lo:hi], e = softmax(hh, p["wo"][g], p["bo"][g], places[lo:hi], learn)
            if learn:
                grads["wo"][g] = hh.T @ e
                grads["bo"][g] = np.ones(len(e), e.dtype) @ e
                np.matmul(e, p["wo"][g].T, out=gone[lo:hi])
        ll[head] += back
        if learn:
            dh[head] += gone
    return ll, grads, dh


def softmax(h: np.ndarray, w: np.ndarray, b: np.ndarray, said: np.ndarray, learn: bool) -> tuple[np.ndarray, np.ndarray]:
    """Natural log probabilities of ``said``; with ``learn`` also the gradients of the logits."""
    e = h @ w
    e += b
    flat = e.reshape(-1)
    at = np.arange(0, len(flat), e.shape[1])
    at += said
    ll = flat[at]
    np.exp(e, out=e)
    total = e @ np.ones(e.shape[1], e.dtype)
    ll -= np.log(total)
    if learn:
        e *= (1 / total)[:, None]
        flat[at] -= 1
    return ll, e


def score(p: Params, texts: Texts) -> np.ndarray:
    """Natural log probability of every whole document, in the order given to ``Texts``."""
    table, wh = gates(p, p["emb"] @ p["wx"] + p["b"])
    total = np.zeros(len(texts.sizes))
    h = np.zeros((len(texts.sizes), STATE), table.dtype)
    for t0 in range(0, texts.longest, WINDOW):
        steps, cls, place = texts.window(t0)
        states = np.empty((len(cls), STATE), table.dtype)
        for ids, lo, hi in steps:
            gx, h = table.take(ids, axis=1), h[:hi - lo]
            gh = h @ wh
            rz, new = gx[:2], gh[2]
            rz += gh[:2]
            half_open(rz)
            new *= rz[0]
            new += gx[2]
            np.tanh(new, out=new)
            h = np.subtract(h, new, out=states[lo:hi])
            h *= rz[1]
            h += new
        ll, _, _ = outputs(p, states, cls, place, False)
        for _, lo, hi in steps:
            total[:hi - lo] += ll[lo:hi]
    out = np.empty_like(total)
    out[texts.order] = total
    return out


def gates(p: Params, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What each input and the state add to the gates, gate by gate (reset, update, new), so that a gate's numbers lie next
    to each other; those of the first two are halved, see ``half_open``."""
    parts = np.array([0.5, 0.5, 1], table.dtype)[:, None, None]
    by_gate = (w.reshape(len(w), 3, STATE).transpose(1, 0, 2) for w in (table, p["wh"]))
    return tuple(np.ascontiguousarray(w) * parts for w in by_gate)


def half_open(x: np.ndarray) -> None:
    """The logistic function of twice ``x``, in its place."""
    np.tanh(x, out=x)
    x *= 0.5
    x += 0.5


def window_gradients(p: Params, table: np.ndarray, texts: Texts, h: np.ndarray, t0: int):
    """(log probability, tokens, gradients, state carried on) of one window; no gradient flows into what lies before."""
    table, wh = gates(p, table)
    steps, cls, place = texts.window(t0)
    n = len(cls)
    before, states, rz, new, ghn = (np.empty((*k, n, STATE), table.dtype) for k in ((), (), (2,), (), ()))
    for ids, lo, hi in steps:
        gx = table.take(ids, axis=1)
        before[lo:hi] = h[:hi - lo]
        gh = before[lo:hi] @ wh
        ghn[lo:hi] = gh[2]
        gate = np.add(gx[:2], gh[:2], out=rz[:, lo:hi])
        half_open(gate)
        made = np.multiply(gate[0], gh[2], out=new[lo:hi])
        made += gx[2]
        np.tanh(made, out=made)
        h = np.subtract(before[lo:hi], made, out=states[lo:hi])
        h *= gate[1]
        h += made
    ll, grads, d = outputs(p, states, cls, place, True)
    # What a change of the state does to each gate's sum: on the state's side, and on the input's for the new value.
    r, z = rz
    dn = (1 - z) * (1 - new * new)
    side = np.empty((3, n, STATE), table.dtype)
    np.multiply(dn * ghn, r * (1 - r), out=side[0])
    np.multiply(before - new, z * (1 - z), out=side[1])
    np.multiply(dn, r, out=side[2])
    back = np.ascontiguousarray(p["wh"].T.reshape(3, STATE, STATE))
    dh = None
    for _, lo, hi in reversed(steps):
        now = d[lo:hi]
        if dh is not None:
            now[:len(dh)] += dh
        dh = now * z[lo:hi]
        for g in (now * side[:, lo:hi]) @ back:
            dh += g
    side *= d
    grads["wh"] = (before.T @ side).transpose(1, 0, 2).reshape(STATE, 3 * STATE)
    np.multiply(d, dn, out=side[2])
    ids = np.concatenate([ids for ids, _, _ in steps])
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
    dgx = side.transpose(1, 0, 2).reshape(n, 3 * STATE)
    dtable = np.zeros((len(p["emb"]), 3 * STATE), table.dtype)
    dtable[ids[first]] = np.add.reduceat(dgx[order], first, axis=0)
    grads |= {"emb": dtable @ p["wx"].T, "wx": p["emb"].T @ dtable, "b": dtable.sum(axis=0)}
    return float(ll.sum()), n, grads, h


class Trainer:
    """Adam steps over documents in lanes."""

    def __init__(self, p: Params, rate: float = RATE):
        self.p = {k: v.copy() for k, v in p.items()}
        self.rate, self.steps, self.seen, self.log = rate, 0, 0, 0.0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def learn(self, docs: list[np.ndarray], end_input: int, outs: tuple[np.ndarray, np.ndarray], lanes: int = LANES) -> None:
        docs = sorted((d[lo:lo + STRETCH] for d in docs for lo in range(0, len(d), STRETCH)), key=len)
        for lo in np.random.default_rng(self.steps).permutation(range(0, len(docs), lanes)):
            texts = Texts(docs[lo:lo + lanes], end_input, outs)
            h = np.zeros((len(texts.sizes), STATE), np.float32)
            for t0 in range(0, texts.longest, WINDOW):
                table = self.p["emb"] @ self.p["wx"] + self.p["b"]
                ll, n, grads, h = window_gradients(self.p, table, texts, h, t0)
                self.log += ll
                self.seen += n
                self.apply(grads, n)

    def apply(self, grads: Params, n: int) -> None:
        self.steps += 1
        size = np.sqrt(sum(float((g * g).sum()) for g in grads.values())) / n
        scale = np.float32(min(1.0, 1.0 / size if size else 1.0) / n)
        fix = self.rate * np.sqrt(1 - 0.999 ** self.steps) / (1 - 0.9 ** self.steps)
        for k, g in grads.items():
            g = g * scale
            self.m[k] += np.float32(0.1) * (g - self.m[k])
            self.v[k] += np.float32(0.001) * (g * g - self.v[k])
            self.p[k] -= np.float32(fix) * self.m[k] / (np.sqrt(self.v[k]) + np.float32(1e-8))
