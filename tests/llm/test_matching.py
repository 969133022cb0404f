import os
import random

import numpy as np
import pytest
import xxhash

from strataflow.llm import simhash
from strataflow.llm import decontaminate
from strataflow.llm.decontaminate import Matcher, best_end, drop_leaks, find_leaks
from strataflow.llm.plain import plain
from strataflow.llm.simhash import (
    close_pairs, component_ids, components, drop_near_duplicates, duplicate_digest, fingerprint, near_duplicates, near_links, spanning_forest,
)
from strataflow.llm.tokens import MARK, VOCABULARY, Counter, count_tokens, read_vocabulary


def edit_best(pattern, text):
    before = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        now = [i]
        for j, b in enumerate(text, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (a != b)))
        before = now
    return min((v, j) for j, v in enumerate(before))


def test_bit_parallel_distance():
    r = random.Random(3)
    for _ in range(300):
        pattern = "".join(r.choice("ab c") for _ in range(r.randint(1, 90)))
        text = "".join(r.choice("ab c") for _ in range(r.randint(0, 120)))
        assert best_end(pattern, text) == edit_best(pattern, text)


def test_every_item_within_the_budget_is_found():
    r = random.Random(4)
    words = ["".join(r.choice("aeinrst") for _ in range(r.randint(2, 7))) for _ in range(60)]
    items = [" ".join(r.choice(words) for _ in range(r.randint(5, 40))) for _ in range(12)]
    matcher = Matcher(items, 0.1)
    for _ in range(40):
        index = r.randrange(len(items))
        copy = list(items[index])
        for _ in range(r.randint(0, matcher.budgets[index] + 3)):
            at = r.randrange(len(copy))
            copy[at : at + 1] = r.choice([[], ["x"], [copy[at], "y"]])
        text = " ".join(r.choice(words) for _ in range(30)) + " " + "".join(copy) + " " + " ".join(r.choice(words) for _ in range(30))
        want = {i: edit_best(item, text)[0] for i, item in enumerate(items)}
        got = {i: d for i, d, *_ in matcher.find(text)}
        assert got == {i: d for i, d in want.items() if d <= matcher.budgets[i]}
        for i, d, start, end in matcher.find(text):
            assert edit_best(items[i], text[start:end])[0] == d


def test_replaced_words_at_the_production_rate(spark):
    one = "the harbour of the northern island was closed for repairs when heavy winter storms broke the old wall"
    two = one + " and the ferries went by another route until early spring of that year when masons had set it up again"
    assert len(one) >= 100 and len(two) >= 200
    texts = [
        f"before it {one.replace('winter', 'summer')} and after it",
        f"x {two.replace('winter', 'summer').replace('masons', 'people')} y",
        f"x {one.replace('winter storms', 'and very long rain').replace('island', 'district')} y",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, one), (2, two)], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in find_leaks(docs, benchmark).collect()}
    assert {(0, 1), (1, 2)} <= found and not any(doc == 2 for doc, _ in found)
    assert [r["doc_id"] for r in drop_leaks(docs, benchmark).collect()] == [2]


def test_leaks_in_odd_rows(spark, odd, nothing):
    items = [(1, "Plain words, of a text with MORE than ten!"), (2, None), (3, ""), (4, "..."), (1, "same id and another"), (None, "still a text")]
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    got = sorted(((r["doc_id"], r["item_id"], r["distance"]) for r in find_leaks(odd, benchmark).collect()), key=str)
    assert got == [(1, 1, 0), (1, 1, 0), (5, 1, 0), (None, None, 0)]
    kept = drop_leaks(odd, benchmark)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 4
    # Items in several blocks give the same.
    assert sorted(((r["doc_id"], r["item_id"], r["distance"]) for r in find_leaks(odd, benchmark, block_chars=30).collect()), key=str) == got
    assert drop_leaks(odd, benchmark, block_chars=30).count() == kept.count()
    assert find_leaks(nothing, benchmark).count() == 0 and find_leaks(odd, benchmark.limit(0)).count() == 0
    assert drop_leaks(odd, benchmark.limit(0)).count() == odd.count() and drop_leaks(nothing, benchmark).count() == 0


def test_repeated_items_are_one_text(spark, monkeypatch):
    """Copies of an item neither fill a block nor lose their ids."""
    text = "the quick brown fox jumps over the lazy dog again and again"
    rows = [(i, text) for i in range(50)] + [(3, text), (None, text), (99, "another item that no document holds at all, ever")]
    benchmark = spark.createDataFrame(rows, "item_id long, text string")
    docs = spark.createDataFrame([(1, f"before {text} after"), (2, "clean")], "doc_id long, text string")
    blocks = list(decontaminate.item_blocks(benchmark, block_chars=10**6))
    assert [len(b) for b in blocks] == [2]
    found = [(r["doc_id"], r["item_id"]) for r in find_leaks(docs, benchmark).collect()]
    assert sorted(found, key=str) == sorted(((1, i) for i, t in rows if t == text), key=str)
    assert [r["doc_id"] for r in drop_leaks(docs, benchmark).collect()] == [2]


def fingerprint_by_hand(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_by_hand(spark):
    for text in ["a b c d", "A b\tC  d", "one", "two words", "", None, " \n", "É é x y z a b", "r r r r r r", " ".join(map(str, range(70_000)))]:
        assert fingerprint(text) % 2**64 == fingerprint_by_hand(text)
    assert duplicate_digest(spark.createDataFrame([(9, None)], "doc_id long, text string")).first().asDict() == {
        "doc_id": 9, "fingerprint": "0" * 16, "component_id": 9,
    }


def clustered(r, n):
    """Random values, some of them in dense balls and chains."""
    values = [r.getrandbits(64) for _ in range(n)]
    for base in values[: n // 20]:
        for _ in range(r.randint(1, 30)):
            base ^= 1 << r.randrange(64) if r.random() < 0.7 else 1 << r.randrange(64) | 1 << r.randrange(64)
            values.append(base)
    return values


def roots_by_hand(values):
    v = np.array([x % 2**64 for x in values], np.uint64)
    label = np.arange(len(v))
    near = np.bitwise_count(v[:, None] ^ v[None, :]) <= 2
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return label
        label = new


def test_tree_finds_all_pairs(monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET", 8)
    v = np.array(sorted(set(clustered(random.Random(5), 600))), np.uint64)
    half = len(v) * 2 // 3
    got = {frozenset(p) for a, b in close_pairs(v[:half], v[half:]) for p in zip(a.tolist(), b.tolist())}
    a, b = np.nonzero(np.bitwise_count(v[:, None] ^ v[None, :]) <= 2)
    want = {frozenset((i, j)) for i, j in zip(a.tolist(), b.tolist()) if i != j and min(i, j) < half}
    assert got == want
    assert (spanning_forest(4, iter([(np.array([2, 3]), np.array([3, 1]))])) == [0, 1, 1, 1]).all()


def test_shards_and_components(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD_POINTS", 64)
    monkeypatch.setattr(simhash, "SAMPLE_PER_SHARD", 16)
    values = [v - 2**63 for v in clustered(random.Random(6), 800)]
    ids = list(range(len(values)))
    random.Random(1).shuffle(ids)
    rows = spark.createDataFrame(list(zip(ids, values)), "doc_id long, fingerprint long")
    named = rows.join(component_ids(rows), "fingerprint")
    got = {r["doc_id"]: r["component_id"] for r in named.collect()}
    label = roots_by_hand(values)
    least = {}
    for i, root in zip(ids, label):
        least[root] = min(least.get(root, i), i)
    assert got == {i: least[root] for i, root in zip(ids, label)}


def test_components_of_a_long_chain(spark):
    edges = spark.range(300).selectExpr("id * 11 % 301 AS a", "(id + 1) * 11 % 301 AS b")
    assert {r["root"] for r in components(edges).collect()} == {0} and components(edges).count() == 300
    assert components(edges.limit(0)).count() == 0


def test_near_duplicates_in_odd_rows(odd, nothing):
    rows = near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    assert {r["component_id"] for r in rows if r["fingerprint"] == 0} == {2}  # NULL and empty texts are one group
    kept = drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    texts = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert len(texts) == len({r["component_id"] if r["component_id"] is not None else -r["fingerprint"] for r in rows})
    assert sum(i == 1 for i, _ in texts) == 1 and (2, None) in texts and (3, "") not in texts
    assert any(i is None for i, _ in texts)  # a group without an id stays as well
    assert near_duplicates(nothing).count() == 0 and drop_near_duplicates(nothing).count() == 0


def test_groups_that_their_id_does_not_tell_apart(spark):
    r = random.Random(8)
    words = [str(r.random()) for _ in range(400)]
    text = " ".join(words)
    near = next(
        other
        for i in range(len(words))
        if 1 <= ((fingerprint(text) ^ fingerprint(other := " ".join(words[:i] + ["x"] + words[i + 1 :]))) % 2**64).bit_count() <= 2
    )
    apart = " ".join(str(r.random()) for _ in range(400))
    rows = [(None, text), (None, near), (7, apart), (7, "of another kind"), (8, apart)]
    kept = drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    left = [(row["doc_id"], row["text"]) for row in kept]
    assert len(left) == 3 and {(7, apart), (7, "of another kind")} < set(left)
    assert sum(i is None for i, _ in left) == 1


needs_vocabulary = pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no vocabulary file")


def reference(pieces, has_bytes):
    from tokenizers import Tokenizer, models, pre_tokenizers

    least = min(score for _, score in pieces)
    special = [("<unk>", least)] + [(f"<0x{i:02X}>", least) for i in range(256) if has_bytes]
    out = Tokenizer(models.Unigram(special + list(pieces), 0, has_bytes))
    out.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.Metaspace()])
    return lambda text: len(out.encode(text, add_special_tokens=False).ids)


def test_counts_with_many_ties():
    r = random.Random(7)
    for _ in range(150):
        pieces = [(w, -float(r.randint(0, 4))) for w in {"".join(r.choice("abcd▁é") for _ in range(r.randint(1, 4))) for _ in range(r.randint(2, 25))}]
        mine, theirs = Counter(pieces, False), reference(pieces, False)
        for _ in range(15):
            text = "".join(r.choice("abcd é\n") for _ in range(r.randint(0, 30)))
            assert mine.total(text) == theirs(text), (text, pieces)


@needs_vocabulary
def test_counts_with_a_public_vocabulary(spark, odd, nothing, sf_dir):
    pieces, has_bytes = read_vocabulary(VOCABULARY)
    theirs = reference(pieces, has_bytes)
    for r in count_tokens(odd).join(odd.select("doc_id", "text").distinct(), "doc_id").where("doc_id NOT IN (5)").collect():
        assert r["n_tokens"] == theirs(r["text"] or "")
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(80)
    rows = count_tokens(texts).join(texts, "doc_id").collect()
    assert all(r["n_tokens"] == theirs(r["text"]) for r in rows)
    assert count_tokens(nothing).count() == 0
    assert Counter(pieces, has_bytes).count(MARK + "\U0001f600") == reference(pieces, has_bytes)("\U0001f600")
    assert plain("A-b, C!") == "a b c"
