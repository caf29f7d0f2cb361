"""Array recursions of the hidden Markov model for one batch of lines inside a task.

Lines are ordered by falling length and their tokens laid out position by position, so
step ``t`` works on the first ``active[t]`` lines as one dense block without padding.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa


class Layout:
    """Position-major order of the tokens of a batch of lines."""

    def __init__(self, lengths: np.ndarray):
        order = np.argsort(-lengths, kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        longest = int(lengths.max(initial=0))
        self.lengths = lengths
        self.rank = rank
        self.active = len(lengths) - np.searchsorted(
            np.sort(lengths), np.arange(longest), side="right"
        )
        self.start = np.concatenate([[0], np.cumsum(self.active)]).astype(np.int64)
        line_start = np.cumsum(lengths) - lengths
        within = np.arange(lengths.sum()) - np.repeat(line_start, lengths)
        #: place of each token, in line order, in the position-major arrays
        self.place = self.start[within] + np.repeat(rank, lengths)

    def steps(self):
        return range(len(self.active))

    def block(self, t: int) -> slice:
        return slice(self.start[t], self.start[t + 1])

    def before(self, t: int) -> slice:
        """The entries of position ``t - 1`` whose line reaches position ``t``."""
        return slice(self.start[t - 1], self.start[t - 1] + self.active[t])

    def scatter(self, values: np.ndarray) -> np.ndarray:
        """State by state in memory: sums and quotients over few states then run along the tokens."""
        out = np.empty(values.shape, values.dtype, order="F")
        out[self.place] = values
        return out

    def gather(self, values: np.ndarray) -> np.ndarray:
        return values[self.place]


class TokenSums:
    """Rows of numbers added up by token over many batches, at most ``limit`` at a time."""

    def __init__(self, width: int, limit: int = 2**19):
        self.width, self.limit = width, limit
        self.parts, self.held = [], 0

    def add(self, tokens: np.ndarray, values: np.ndarray):
        """Yields sums that are handed on, if too many are held."""
        self.parts.append(self._summed(tokens, values))
        self.held += len(self.parts[-1][0])
        if self.held > self.limit:
            merged = self._merged()
            if len(merged[0]) > self.limit // 2:
                self.parts, self.held = [], 0
                yield merged
            else:
                self.parts, self.held = [merged], len(merged[0])

    def rest(self):
        if self.parts:
            yield self._merged()
            self.parts, self.held = [], 0

    def _merged(self):
        tokens, values = zip(*self.parts, strict=True)
        return self._summed(np.concatenate(tokens), np.concatenate(values))

    def _summed(self, tokens, values):
        distinct, slot = np.unique(tokens, return_inverse=True)
        columns = [
            np.bincount(slot, weights=values[:, s], minlength=len(distinct))
            for s in range(self.width)
        ]
        return distinct, np.column_stack(columns)


def _nonzero(x):
    return np.where(x > 0, x, 1.0)


def forward(layout: Layout, e, a, pi):
    """Filtered state probabilities of each position and the scale factors."""
    alpha = np.empty_like(e)
    scale = np.empty(len(e))
    for t in layout.steps():
        here = layout.block(t)
        prior = pi if t == 0 else alpha[layout.before(t)] @ a
        joint = prior * e[here]
        scale[here] = joint.sum(axis=1)
        alpha[here] = joint / _nonzero(scale[here])[:, None]
    return alpha, scale


def backward(layout: Layout, e, a, scale):
    """Backward values divided by the same scale factors, so they cannot underflow."""
    beta = np.ones_like(e)
    for t in reversed(layout.steps()):
        if t > 0:
            here = layout.block(t)
            ahead = e[here] * beta[here] / _nonzero(scale[here])[:, None]
            beta[layout.before(t)] = ahead @ a.T
    return beta


def posterior(alpha, beta):
    gamma = alpha * beta
    return gamma / _nonzero(gamma.sum(axis=1))[:, None]


def expected_transitions(layout: Layout, e, a, alpha, beta, scale):
    """Posterior transition counts summed over the positions of the batch."""
    if len(layout.active) < 2:
        return np.zeros_like(a)
    left = np.concatenate([np.arange(s.start, s.stop) for s in map(layout.before, layout.steps()[1:])])
    right = slice(layout.start[1], layout.start[-1])
    ahead = e[right] * beta[right] / _nonzero(scale[right])[:, None]
    total = (alpha[left] * (ahead @ a.T)).sum(axis=1)
    return a * ((alpha[left] / _nonzero(total)[:, None]).T @ ahead)


def expectations(layout: Layout, e, a, pi):
    """State probabilities of each position, transition counts and scale factors of a batch.

    As ``forward``, ``backward``, ``posterior`` and ``expected_transitions`` give them, whose
    common parts are worked out once.
    """
    alpha, scale = forward(layout, e, a, pi)
    ahead = np.empty_like(e)
    beta = np.ones_like(e)
    for t in reversed(layout.steps()[1:]):
        here = layout.block(t)
        ahead[here] = e[here] * beta[here] / _nonzero(scale[here])[:, None]
        beta[layout.before(t)] = ahead[here] @ a.T
    beta *= alpha
    total = _nonzero(beta.sum(axis=1))[:, None]
    beta /= total
    if len(layout.active) < 2:
        return beta, np.zeros_like(a), scale
    left = np.concatenate([np.arange(s.start, s.stop) for s in map(layout.before, layout.steps()[1:])])
    right = slice(layout.start[1], layout.start[-1])
    return beta, a * ((alpha / total)[left].T @ ahead[right]), scale


def viterbi(layout: Layout, log_e, log_a, log_pi):
    """Best state of each position and the log score of each line, ties to the lowest.

    The emission counts in the choice of the state before: where no state emits a token
    all options are as bad, and the lowest state is taken.
    """
    score = np.empty_like(log_e)
    source = np.zeros(log_e.shape, dtype=np.int32)
    for t in layout.steps():
        here = layout.block(t)
        if t == 0:
            score[here] = log_pi + log_e[here]
            continue
        options = score[layout.before(t)][:, :, None] + log_a[None, :, :]
        options = options + log_e[here][:, None, :]
        source[here] = options.argmax(axis=1)
        score[here] = options.max(axis=1)
    path = np.empty(len(log_e), dtype=np.int32)
    final = np.empty(len(layout.lengths))
    state = np.zeros(len(layout.lengths), dtype=np.int64)
    following = 0
    for t in reversed(layout.steps()):
        here, n = layout.block(t), layout.active[t]
        ending = np.arange(following, n)
        if following:
            state[:following] = source[layout.block(t + 1)][
                np.arange(following), state[:following]
            ]
        last = score[here][ending]
        state[ending] = last.argmax(axis=1)
        final[ending] = last.max(axis=1)
        path[here] = state[:n]
        following = n
    return path, final[layout.rank]


def list_parts(batch: pa.RecordBatch, name: str):
    """Lengths and joined values of a list column, without Python objects."""
    column = batch.column(batch.schema.get_field_index(name))
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    return np.diff(offsets), values


#: Batches that are cut from lines put in order of length together.
AHEAD = 16


def cut_batches(batches, limit: int):
    """Cut incoming batches so that each has about ``limit`` tokens; lines stay whole.

    A batch takes as many steps as its longest line has tokens. So lines are put in order of
    length first, about ``AHEAD`` batches of them at a time.
    """
    held, tokens = [], 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append(batch)
        tokens += int(list_parts(batch, "ids")[0].sum())
        if tokens >= AHEAD * limit:
            yield from _cut(held, limit)
            held, tokens = [], 0
    if held:
        yield from _cut(held, limit)


def _cut(held: list[pa.RecordBatch], limit: int):
    for batch in pa.Table.from_batches(held).combine_chunks().to_batches():
        lengths = list_parts(batch, "ids")[0]
        order = np.argsort(-lengths, kind="stable")
        batch, ends = batch.take(pa.array(order)), np.cumsum(lengths[order])
        first = 0
        while first < batch.num_rows:
            done = ends[first - 1] if first else 0
            last = max(int(np.searchsorted(ends, done + limit, side="right")), first + 1)
            yield batch.slice(first, last - first)
            first = last


def looked_up(ids, head: np.ndarray, tokens, numbers) -> np.ndarray:
    """Emission rows of ``ids``: low ones from ``head``, others from a sorted list of tokens.

    The last row of ``head`` is for ids below 0; a token that neither has gets zeros.
    """
    states, size = head.shape[1], len(head) - 1
    found = np.zeros((len(ids), states))
    low = ids < size
    found[low] = head[ids[low]]
    high = np.flatnonzero(~low)
    tokens = tokens.to_numpy(zero_copy_only=False).astype(np.int64)
    table = numbers.to_numpy(zero_copy_only=False).reshape(-1, states)
    at = np.searchsorted(tokens, ids[high])
    known = np.append(tokens, -1)[at] == ids[high]
    found[high[known]] = table[at[known]]
    return found


def list_column(lengths: np.ndarray, flat: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def log_likelihood(layout: Layout, scale: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        logs = np.log(layout.gather(scale))
    starts = np.cumsum(layout.lengths) - layout.lengths
    return np.add.reduceat(logs, starts)


# ------------------------------------------------------------- lines cut into chunks
#
# A chunk stands for the product of its steps' matrices: K rows that sum to one, and the
# logarithm of what each row was divided by. Chunks multiply, so a line's chunks can be
# worked on anywhere and put together in a tree.


def _normalised(rows, logs):
    total = rows.sum(axis=-1)
    with np.errstate(divide="ignore"):
        return rows / _nonzero(total)[..., None], logs + np.log(total)


def _weights(logs):
    """Rows' weights relative to the largest, and the logarithm of that one."""
    top = logs.max(axis=-1)
    finite = np.isfinite(top)
    shifted = np.where(np.isfinite(logs), logs - np.where(finite, top, 0.0)[..., None], -np.inf)
    return np.exp(shifted), np.where(finite, top, -np.inf)


def chunk_products(layout: Layout, e, a, first):
    """Rows and logarithms of every chunk of a batch; ``first`` marks those that begin a line.

    The first position of a line has no move before it: its matrix is diagonal.
    """
    n, k = len(layout.lengths), len(a)
    rows, logs = np.zeros((n, k, k)), np.zeros((n, k))
    begins = np.empty(n, dtype=bool)
    begins[layout.rank] = first
    for t in layout.steps():
        m = layout.active[t]
        here = e[layout.block(t)][:, None, :]
        if t == 0:
            moved = np.where(begins[:, None, None], np.eye(k)[None], a[None])
        else:
            moved = rows[:m] @ a
        rows[:m], logs[:m] = _normalised(moved * here, logs[:m])
    return rows[layout.rank], logs[layout.rank]


def composed(rows, logs):
    """One product of consecutive ones."""
    whole, total = rows[0], logs[0]
    for right, right_logs in zip(rows[1:], logs[1:], strict=True):
        weights, top = _weights(right_logs)
        whole, total = _normalised((whole * weights) @ right, total + top)
    return whole, total


def entered(rows, logs, left, right):
    """State probabilities before each of consecutive chunks, and backward values after it."""
    before, after = [left], [right]
    for chunk, chunk_logs in zip(rows[:-1], logs[:-1], strict=True):
        moved = (before[-1] * _weights(chunk_logs)[0]) @ chunk
        before.append(moved / _nonzero(moved.sum()))
    for chunk, chunk_logs in zip(rows[:0:-1], logs[:0:-1], strict=True):
        moved = _weights(chunk_logs)[0] * (chunk @ after[-1])
        after.append(moved / _nonzero(moved.sum()))
    return before, after[::-1]


def composed_runs(runs: Layout, rows, logs):
    """``composed`` for many runs of consecutive matrices at once; a run is a line of ``runs``."""
    rows, logs = runs.scatter(rows), runs.scatter(logs)
    whole, total = rows[runs.block(0)].copy(), logs[runs.block(0)].copy()
    for t in runs.steps()[1:]:
        m, here = runs.active[t], runs.block(t)
        weights, top = _weights(logs[here])
        moved = (whole[:m] * weights[:, None, :]) @ rows[here]
        whole[:m], total[:m] = _normalised(moved, total[:m] + top[:, None])
    return whole[runs.rank], total[runs.rank]


def entered_runs(runs: Layout, rows, logs, left, right):
    """``entered`` for many runs at once, with a row of ``left`` and of ``right`` for each run."""
    weighted = runs.scatter(_weights(logs)[0][:, :, None] * rows)
    order = np.empty(len(runs.rank), dtype=np.int64)
    order[runs.rank] = np.arange(len(order))
    before, after = np.empty(weighted.shape[:2]), np.empty(weighted.shape[:2])
    for t in runs.steps():
        if t == 0:
            before[runs.block(0)] = left[order]
            continue
        moved = np.einsum("ni,nij->nj", before[runs.before(t)], weighted[runs.before(t)])
        before[runs.block(t)] = moved / _nonzero(moved.sum(axis=1))[:, None]
    following = 0
    for t in reversed(runs.steps()):
        here, n = runs.block(t), runs.active[t]
        if following:
            ahead = runs.block(t + 1)
            moved = np.einsum("nij,nj->ni", weighted[ahead], after[ahead])
            after[here.start : here.start + following] = moved / _nonzero(moved.sum(axis=1))[:, None]
        after[here.start + following : here.stop] = right[order[following:n]]
        following = n
    return runs.gather(before), runs.gather(after)


def chunk_passes(layout: Layout, e, a, prior, right):
    """Filtered probabilities, backward values that sum to one, and scale factors.

    ``prior`` has each chunk's state probabilities at its first position before the token is
    seen, ``right`` its backward values at the last one.
    """
    alpha, beta, scale = np.empty_like(e), np.empty_like(e), np.empty(len(e))
    order = np.empty(len(layout.rank), dtype=np.int64)
    order[layout.rank] = np.arange(len(order))
    for t in layout.steps():
        here = layout.block(t)
        ahead = prior[order] if t == 0 else alpha[layout.before(t)] @ a
        joint = ahead * e[here]
        scale[here] = joint.sum(axis=1)
        alpha[here] = joint / _nonzero(scale[here])[:, None]
    following = 0
    for t in reversed(layout.steps()):
        here, n = layout.block(t), layout.active[t]
        if following:
            moved = (e[layout.block(t + 1)] * beta[layout.block(t + 1)]) @ a.T
            beta[here.start : here.start + following] = moved
        beta[here.start + following : here.stop] = right[order[following:n]]
        beta[here] /= _nonzero(beta[here].sum(axis=1))[:, None]
        following = n
    return alpha, beta, scale
