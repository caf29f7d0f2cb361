import numpy as np
import pyarrow as pa
import pytest

from corpusloom.operators import hmm_kernel as kernel


def batch_of(lengths, first=0):
    ids = pa.array([[i] * n for i, n in enumerate(lengths, first)], pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array(np.arange(first, first + len(lengths))), ids], ["id", "ids"])


def test_a_long_line_does_not_lengthen_every_batch():
    """a batch takes as many steps as its longest line has tokens."""
    lengths = [100 if i % 10 == 0 else 5 for i in range(100)]
    batches = [batch_of(lengths[:50]), batch_of(lengths[50:], 50), batch_of([])]
    cut = list(kernel.cut_batches(batches, 200))
    longest = [int(kernel.list_parts(b, "ids")[0].max()) for b in cut]
    assert sorted(i for b in cut for i in b.column(0).to_pylist()) == list(range(100))
    for b in cut:
        assert all(set(ids) == {i} for i, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        assert kernel.list_parts(b, "ids")[0].sum() <= 200
    assert sum(longest) <= 5 * 100 + 3 * 5


def test_a_line_longer_than_a_batch_stays_whole():
    cut = list(kernel.cut_batches([batch_of([3, 50, 2])], 10))
    assert [b.column(0).to_pylist() for b in cut] == [[1], [0, 2]]


@pytest.mark.parametrize("lengths", [[1], [1, 1], [3, 1, 7, 2]])
def test_expectations_are_those_of_the_single_functions(lengths):
    rng = np.random.default_rng(1)
    a, pi = rng.dirichlet(np.ones(3), 3), rng.dirichlet(np.ones(3))
    layout = kernel.Layout(np.array(lengths))
    e = layout.scatter(rng.random((sum(lengths), 3)))
    e[rng.random(len(e)) < 0.2] = 0
    gamma, moves, scale = kernel.expectations(layout, e, a, pi)
    alpha, scales = kernel.forward(layout, e, a, pi)
    beta = kernel.backward(layout, e, a, scales)
    assert scale == pytest.approx(scales)
    assert gamma == pytest.approx(kernel.posterior(alpha, beta))
    assert moves == pytest.approx(kernel.expected_transitions(layout, e, a, alpha, beta, scales))
