"""A small causal self-attention language model in numpy.

Frequent tokens are classes of their own, the others share classes by a clustering of what precedes them. Classes stand
in groups of alike ones, ``GROUP`` to a group. The model gives the next token's group, then its class in the group, from
the classes before it, and the token from its class's counts. Both steps' logits are a bigram's logarithm plus what one
attention head over the window adds: queries, keys and values are tables by class, a learned bias depends on the distance,
and positions after the query are masked. Windows overlap: each has ``WINDOW`` positions, of which the last ``STEP`` are
scored, so every token is scored once and with context; windows run in batches.
"""

from __future__ import annotations

import numpy as np

#: Every scored position sees at least WINDOW - STEP tokens before it, half a window.
WINDOW, STEP, WIDTH, GROUP = 64, 32, 16, 32
#: Windows whose arrays fit a core's cache, and windows held for the second step.
BATCH, HELD = 96, 1536


def segments(sequences: list[np.ndarray], pad: int) -> tuple[np.ndarray, np.ndarray]:
    """All inputs in one padded array, and where each window starts in it."""
    parts, starts, at = [], [], 0
    for s in sequences:
        m = -(-len(s) // STEP)
        row = np.full(WINDOW - STEP + m * STEP, pad, s.dtype)
        row[WINDOW - STEP : WINDOW - STEP + len(s)] = s
        parts.append(row)
        starts.append(at + STEP * np.arange(m))
        at += len(row)
    return np.concatenate(parts), np.concatenate(starts)


def fresh(classes: int, seed: int = 0) -> dict[str, np.ndarray]:
    """Tables have a row more than there are classes: padding, which is always masked."""
    rnd = np.random.default_rng(seed)
    table = lambda: rnd.normal(0, 0.3, (classes + 1, WIDTH)).astype(np.float32)
    groups = classes // GROUP
    return {"q": table(), "k": table(), "v": table(), "b": np.zeros(WINDOW, np.float32), "o": np.zeros((WIDTH, groups), np.float32), "i": np.zeros((groups, WIDTH, GROUP), np.float32)}


def bigrams(both: np.ndarray, trust: float = 20.0) -> tuple[np.ndarray, np.ndarray]:
    """From counts of (class, next class): logarithms of the next group by class, and of the place in it by (group, class).

    Each row is mixed with ``trust`` counts of the overall shares. Padding has a last row of zeros.
    """
    n = len(both)
    by_group = both.reshape(n, n // GROUP, GROUP)

    def logs(x: np.ndarray) -> np.ndarray:
        share = (x.sum(0) + 1) / (x.sum() + x.shape[1])
        rows = np.log((x + trust * share) / (x.sum(1, keepdims=True) + trust))
        return np.vstack([rows, np.zeros((1, x.shape[1]))]).astype(np.float32)

    return logs(by_group.sum(2)), np.stack([logs(by_group[:, g]) for g in range(n // GROUP)])


_AGE = np.arange(WINDOW - STEP, WINDOW)[:, None] - np.arange(WINDOW)[None, :]  # query's position minus key's
_SEEN = _AGE >= 0
#: Logits beyond this are held there, biases at a third of it, so exponentials need no maximum taken off and never overflow.
MOST = 60


def _weights(p: dict, pad: int, context: np.ndarray) -> tuple:
    """Unnormalised attention of the last STEP positions of each window, its sums, and queries, keys and values."""
    q, k, v = (np.take(p[n], x, axis=0) for n, x in (("q", context[:, -STEP:]), ("k", context), ("v", context)))
    q *= q.dtype.type(WIDTH**-0.5)
    a = q @ k.transpose(0, 2, 1)
    np.clip(a, -MOST, MOST, out=a)
    np.exp(a, out=a)
    a *= (np.exp(np.clip(p["b"], -MOST / 3, MOST / 3))[np.maximum(_AGE, 0)] * _SEEN).astype(a.dtype)
    head = np.flatnonzero(context[:, 0] == pad)  # only a text's first window begins with padding
    if len(head):
        a[head] *= (context[head] != pad)[:, None, :]
    return a, a @ np.ones(WINDOW, a.dtype), q, k, v


def attend(p: dict, pad: int, context: np.ndarray) -> np.ndarray:
    """What the last STEP positions of each window see, (windows, STEP, WIDTH)."""
    a, total, _, _, v = _weights(p, pad, context)
    return (a @ v) / np.maximum(total, 1e-30)[..., None]


def _grouped(want: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts equal groups together, and where each begins and ends in it."""
    group = (want // GROUP).astype(np.uint16)  # short integers sort by radix
    return np.argsort(group, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(group, minlength=groups))])


def _runs(ends: np.ndarray) -> list[tuple[int, slice]]:
    """The groups that aren't empty, and their places."""
    ends = ends.tolist()
    return [(g, slice(a, b)) for g, (a, b) in enumerate(zip(ends, ends[1:], strict=False)) if a < b]


def _inner(p: dict, second: np.ndarray, h: np.ndarray, asked: np.ndarray, group: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Logits of the place in the group, for rows ordered by group."""
    z = np.take(second.reshape(-1, GROUP), group * second.shape[1] + asked, axis=0)
    added = np.empty_like(z)
    for g, own in _runs(ends):
        np.matmul(h[own], p["i"][g], out=added[own])
    z += added
    return z


def _exponentials(z: np.ndarray) -> np.ndarray:
    """In place; returns the sums of rows. Bigrams' logarithms and what is added are bounded below, so no sum is zero."""
    np.clip(z, -MOST, MOST, out=z)
    np.exp(z, out=z)
    return z @ np.ones(z.shape[1], z.dtype)


def class_scores(p: dict, first: np.ndarray, second: np.ndarray, inputs: list[np.ndarray], targets: list[np.ndarray]) -> np.ndarray:
    """Natural logarithms of the probability of each target's class, sequence after sequence."""
    pad = len(p["q"]) - 1
    buf, starts = segments(inputs, pad)
    goal, _ = segments(targets, pad)
    out, at = np.empty(len(buf), np.float32), np.arange(WINDOW)
    for i in range(0, len(starts), BATCH):
        place = starts[i : i + BATCH, None] + at
        context, last = buf[place], place[:, -STEP:].ravel()
        want = np.minimum(goal[last], pad - 1)
        order, ends = _grouped(want, len(second))
        h, asked, want = attend(p, pad, context).reshape(-1, WIDTH)[order], buf[last][order], want[order]
        rows, group = np.arange(len(want)), want // GROUP
        got = np.zeros(len(want), h.dtype)
        for z, pick in ((np.take(first, asked, axis=0) + h @ p["o"], group), (_inner(p, second, h, asked, group, ends), want % GROUP)):
            total = _exponentials(z)
            got += np.log(z[rows, pick] / total)
        out[last[order]] = got
    return out[goal != pad]


def _summed(table: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    order = np.argsort(rows.astype(np.uint16), kind="stable")
    rows = rows[order]
    first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
    pairs = np.take(values, order, axis=0).view(np.result_type(values, np.complex64))  # two numbers as one: half as many additions
    table[rows[first]] += np.add.reduceat(pairs, first, axis=0).view(values.dtype)


def _slope(z: np.ndarray, want: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, float]:
    """Gradient of the summed loss by the logits, times ``scale``, and the loss."""
    total = _exponentials(z)
    line, at = z.reshape(-1), np.arange(0, z.size, z.shape[1]) + want
    loss = -float(np.log(line[at] / total) @ scale)
    z *= (scale / total)[:, None]
    line[at] -= scale
    return z, loss


def gradients(p: dict, first: np.ndarray, second: np.ndarray, context: np.ndarray, target: np.ndarray) -> tuple[dict, float]:
    """Of the mean loss over targets that aren't padding."""
    pad = len(p["q"]) - 1
    goal = target.ravel()
    a, total, q, k, v = _weights(p, pad, context)
    total = np.maximum(total, 1e-30)[..., None]
    h = a @ v
    h /= total
    kind = h.dtype
    want = np.minimum(goal, pad - 1)
    order, ends = _grouped(want, len(second))
    flat, asked, want = np.take(h.reshape(-1, WIDTH), order, axis=0), context[:, -STEP:].ravel()[order], want[order]
    live = goal[order] != pad
    scale = (live / max(1, live.sum())).astype(kind)
    group = want // GROUP
    g = {n: np.zeros_like(x) for n, x in p.items()}
    dz, loss = _slope(np.take(first, asked, axis=0) + flat @ p["o"], group, scale)
    g["o"] += flat.T @ dz
    ds = dz @ p["o"].T
    dz, more = _slope(_inner(p, second, flat, asked, group, ends), want % GROUP, scale)
    for x, own in _runs(ends):
        np.matmul(flat[own].T, dz[own], out=g["i"][x])
        ds[own] += dz[own] @ p["i"][x].T
    dh = np.empty_like(ds)
    dh[order] = ds
    dh = dh.reshape(h.shape)
    dh /= total
    da = dh @ v.transpose(0, 2, 1)
    da -= np.einsum("bij,bij->bi", dh, h)[..., None]  # the sum of weights times their slopes
    da *= a
    g["b"] += np.bincount(np.maximum(_AGE, 0).ravel(), np.ones(len(da), kind) @ da.reshape(len(da), -1), WINDOW).astype(kind)
    _summed(g["q"], context[:, -STEP:].ravel(), (da @ k).reshape(-1, WIDTH) * kind.type(WIDTH**-0.5))
    both = np.empty((*context.shape, 2 * WIDTH), kind)
    np.matmul(da.transpose(0, 2, 1), q, out=both[..., :WIDTH])
    np.matmul(a.transpose(0, 2, 1), dh, out=both[..., WIDTH:])
    kv = np.zeros((pad + 1, 2 * WIDTH), kind)
    _summed(kv, context.ravel(), both.reshape(-1, 2 * WIDTH))
    g["k"] += kv[:, :WIDTH]
    g["v"] += kv[:, WIDTH:]
    return g, loss + more


def train(p: dict, first: np.ndarray, second: np.ndarray, context: np.ndarray, target: np.ndarray, seen: dict | None = None, rate: float = 0.1, batch: int = BATCH) -> tuple[dict, dict]:
    """One pass of AdaGrad over windows in the given order; ``seen``: the squares summed so far."""
    p = {n: x.copy() for n, x in p.items()}
    seen = seen or {n: np.full_like(x, 1e-6) for n, x in p.items()}
    for i in range(0, len(context), batch):
        g, _ = gradients(p, first, second, context[i : i + batch], target[i : i + batch])
        for n, x in g.items():
            step = x * x
            seen[n] += step
            np.sqrt(seen[n], out=step)
            np.divide(x, step, out=step)
            step *= rate
            p[n] -= step
    return p, seen


def token_classes(counts: np.ndarray, before: np.ndarray, classes: int, shared: int, rounds: int = 8) -> np.ndarray:
    """A class for each token: ``counts`` by token, ``before`` the counts of what precedes it (tokens by kinds).

    All but ``shared`` classes are single tokens. Tokens are clustered by what precedes them; classes are numbered by
    cluster, so that groups hold alike ones.
    """
    order = np.lexsort((np.arange(len(counts)), -counts))
    rows = np.sqrt((before + 0.5 * before.sum(0) / max(1, before.sum())) / (counts[:, None] + 0.5))
    seen = order[: max(shared, int((counts > 0).sum()))]
    centers = rows[seen[: classes // GROUP]].copy()
    near = np.zeros(len(counts), np.int64)
    nearest = lambda x: np.argmin((centers**2).sum(1) - 2 * rows[x] @ centers.T, 1)
    weight = np.sqrt(counts.astype(np.float64))
    for _ in range(rounds):
        near[seen] = nearest(seen)
        for c in range(len(centers)):
            own = seen[near[seen] == c]
            if weight[own].sum():
                centers[c] = np.average(rows[own], axis=0, weights=weight[own])
    singles, rest = order[: classes - shared], order[classes - shared :]
    unit = np.empty(len(counts), np.int64)
    unit[singles] = np.arange(len(singles))
    # tokens that share a class: by cluster, as many classes as asked
    ranked = rest[np.lexsort((rest, near[rest]))]
    used = ranked[counts[ranked] > 0]
    unit[ranked] = classes - 1
    unit[used] = classes - shared + np.arange(len(used)) * (shared - 1) // max(1, len(used))
    cluster = np.full(classes, len(centers))
    cluster[: len(singles)] = near[singles]
    place = np.empty(classes, np.int64)
    place[np.lexsort((np.arange(classes), cluster))] = np.arange(classes)
    return place[unit].astype(np.int32)
