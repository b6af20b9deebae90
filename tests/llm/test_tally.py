import numpy as np
import pyarrow as pa
import pytest

from strataspark.llm import tally


def by_bucket(tables):
    rows = pa.concat_tables(tables)
    for k in sorted(set(rows.column("bucket").to_pylist())):
        yield tally.answered(rows.filter(pa.compute.equal(rows.column("bucket"), k)))


@pytest.mark.parametrize("buckets", [1, 7, 1_000, 1_000_000])
def test_counts_are_told_back_whatever_the_number_of_buckets(buckets):
    rng = np.random.default_rng(buckets)
    pool = rng.integers(0, 1 << 64, 3_000, np.uint64)
    slices = [np.unique(rng.choice(pool, 2_000), return_counts=True) for _ in range(3)]
    sent = [tally.sent(name, keys, counts, buckets) for name, (keys, counts) in enumerate(slices)]
    sent.append(tally.sent(None, slices[0][0], slices[0][1] * 1_000, buckets))  # tells, does not ask
    sent.append(tally.sent(3, pool[:0], None, buckets))
    assert all(t.num_rows <= min(buckets, 2_000) for t in sent)
    answers = pa.concat_tables(list(by_bucket(sent)))
    total = {}
    for keys, counts in [*slices, (slices[0][0], slices[0][1] * 1_000)]:
        for k, n in zip(keys.tolist(), counts.tolist(), strict=True):
            total[k] = total.get(k, 0) + n
    for name, (keys, _) in enumerate(slices):
        mine = answers.filter(pa.compute.equal(answers.column("slice"), name))
        assert tally.told(mine, keys, buckets).tolist() == [total[k] for k in keys.tolist()]
    assert len(tally.told(answers.slice(0, 0), pool[:0], buckets)) == 0


def test_a_slice_walks_only_the_buckets_it_has_keys_in():
    keys = np.array([0, 1 << 40, (1 << 64) - 1], np.uint64)
    for buckets in (1_000, 1_000_000):
        own, edge = tally.runs(keys, buckets)
        assert own == [0, buckets - 1] and edge == [0, 2, 3]
