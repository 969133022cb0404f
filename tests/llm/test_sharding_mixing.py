from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strataflow.llm.mixing import mix_sources, run_slots, whole_run, whole_weights
from strataflow.llm.rows import number_rows
from strataflow.llm.sharding import permute, shard_digest, shard_documents


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 3000), st.integers(0, 2**31))
def test_permutation_is_one(n, seed):
    assert sorted(permute(np.arange(n), n, seed)) == list(range(n))


def test_permutation_shuffles_and_repeats():
    places = permute(np.arange(10_000), 10_000)
    assert (places == permute(np.arange(10_000), 10_000)).all()
    assert abs(np.corrcoef(np.arange(10_000), places)[0, 1]) < 0.05
    # A number's place can be found alone.
    assert permute(np.array([1234]), 10_000)[0] == places[1234]


def shards_hold(rows, shards, total):
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert sum(map(len, by.values())) == total
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    sizes = [len(by.get(i, [])) for i in range(shards)]
    assert max(sizes) - min(sizes) <= 1


def test_shards_of_odd_rows(odd, nothing):
    got = shard_digest(odd, 3)
    rows = got.collect()
    shards_hold(rows, 3, odd.count())
    assert {r["law"] for r in rows} == {"rows"} and {r["grown_shard"] for r in rows} == {None}
    by_size = Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows)
    assert by_size[(2, 1, None)] == 1 and by_size[(3, 1, 0)] == 1 and by_size[(6, 50_001, by_size and [r["text_crc32"] for r in rows if r["doc_id"] == 6][0])] == 1
    assert sorted(map(str, rows)) == sorted(map(str, shard_digest(odd.repartition(5), 3).collect()))
    assert shard_digest(nothing).count() == 0
    whole = shard_documents(odd, 2)
    shards_hold(whole.collect(), 2, odd.count())
    assert set(whole.columns) == set(odd.columns)


def test_row_numbers_with_one_hot_row(spark):
    same = spark.range(5000).selectExpr("1L AS id")
    rows, total = number_rows(same, ["id"], "n")
    assert total == 5000
    assert sorted(r["n"] for r in rows.collect()) == list(range(5000))


def test_mixture_is_whole_and_meets_weights(spark):
    rows = spark.createDataFrame([(i, "big" if i % 10 else "small") for i in range(500)], "doc_id long, source string")
    mixed = mix_sources(rows, {"big": 1, "small": 1}, block_rows=5).collect()
    assert {r["doc_id"] for r in mixed} == set(range(500))
    assert len({(r["slot"], r["place"]) for r in mixed}) == len(mixed)
    share = Counter(r["source"] for r in mixed)
    assert abs(share["big"] - share["small"]) <= 5
    # Each slot is one source's, and the small source goes round.
    owner = {}
    for r in mixed:
        assert owner.setdefault(r["slot"], r["source"]) == r["source"]
    assert max(r["epoch"] for r in mixed if r["source"] == "small") >= 8
    assert {r["epoch"] for r in mixed if r["source"] == "big"} == {0}


def test_many_epochs_are_dealt_out(spark, monkeypatch):
    import strataflow.llm.mixing as mixing

    rows = spark.createDataFrame([(i, "a" if i else "b") for i in range(200)], "doc_id long, source string")
    plain = sorted(map(str, mix_sources(rows, {"a": 1, "b": 1}, block_rows=2).collect()))
    monkeypatch.setattr(mixing, "EPOCHS_PER_TASK", 3)
    assert sorted(map(str, mix_sources(rows, {"a": 1, "b": 1}, block_rows=2).collect())) == plain


def test_mixing_odd_rows(odd, nothing):
    mixed = mix_sources(odd, block_rows=2)
    rows = mixed.collect()
    assert set(odd.columns) <= set(mixed.columns)
    assert Counter((r["doc_id"], r["text"], r["source"]) for r in rows).keys() == {(r["doc_id"], r["text"], r["source"]) for r in odd.collect()}
    assert len([r for r in rows if r["doc_id"] == 1 and r["epoch"] == 0]) == 2
    assert mix_sources(nothing).count() == 0
    with pytest.raises(ValueError):
        mix_sources(odd, {"a": 1})


@pytest.mark.parametrize("sizes", [[10**5] * 3 + [16] * 5, [50_000 // i for i in range(1, 601)], [1] * 1500 + [3000], [7]])
def test_whole_run_stays_within_a_block_of_the_weights(sizes):
    weights = [n**0.85 for n in sizes]
    exact = whole_weights(weights)
    blocks = [-(-n // 16) for n in sizes]
    slots = run_slots(exact, blocks)
    share, done = np.array(weights) / sum(weights), np.zeros(len(sizes))
    for t, i in enumerate(whole_run(exact, slots), 1):
        done[i] += 1
        if t % 7 == 0 or t == slots:
            assert np.abs(done - share * t).max() < 1 + 1e-6
    assert (done >= blocks).all()


def test_whole_run_mixture_meets_the_given_weights(spark):
    rows = spark.createDataFrame([(i, "big" if i > 3 else f"tiny{i}") for i in range(1000)], "doc_id long, source string")
    weights = {"big": 1000, **{f"tiny{i}": 1 for i in range(4)}}
    mixed = mix_sources(rows, weights, block_rows=2).collect()
    assert {r["doc_id"] for r in mixed} == set(range(1000))
    blocks = Counter(source for source, _ in {(r["source"], r["slot"]) for r in mixed})
    slots = sum(blocks.values())
    assert {r["slot"] for r in mixed} == set(range(slots))
    assert all(abs(n - weights[s] / 1004 * slots) < 1 for s, n in blocks.items())


def test_many_sources(spark):
    n = 1500
    rows = spark.createDataFrame([(i, f"s{i % n}") for i in range(n + 50)], "doc_id long, source string")
    mixed = mix_sources(rows).collect()
    assert {r["doc_id"] for r in mixed} == set(range(n + 50))
    assert len({(r["slot"], r["place"]) for r in mixed}) == len(mixed)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.floats(1e-6, 1e6), min_size=1, max_size=12), st.integers(1, 2000))
def test_any_weights_are_met_within_a_block(weights, slots):
    exact = whole_weights(weights)
    share, done = np.array(exact) / sum(exact), np.zeros(len(weights))
    assert np.allclose(share, np.array(weights) / sum(weights), atol=1e-9)
    for t, i in enumerate(whole_run(exact, slots), 1):
        done[i] += 1
        assert np.abs(done - share * t).max() < 1 + 1e-9


def test_shards_do_not_depend_on_the_files(spark):
    """Rows that differ in a further column alone, a map among them, in two layouts."""
    rows = [(i % 100, f"text {i % 100}", f"more {i}", {"b": str(i), "a": "x"}) for i in range(400)]
    schema = "doc_id long, text string, more string, tags map<string,string>"
    one = spark.createDataFrame(rows, schema).coalesce(1)
    other = spark.createDataFrame(rows[::-1], schema).repartition(7)
    placed = [{r["more"]: (r["shard"], r["slot"]) for r in shard_documents(frame, 5).collect()} for frame in (one, other)]
    assert placed[0] == placed[1] and len(set(placed[0].values())) == 400
