"""Operators 11 to 13 against brute force, and their defined cases."""

import hashlib
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import strataflow.llm.collocations as collocations
from strataflow.llm.collocations import count_phrases, mine_phrases
from strataflow.llm.exact_dedup import PatriciaTrie, dedup_exact
from strataflow.llm.filter_audit import FILTERS, audit_filters, removal_steps, text_mask

ASCII_LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


# Exact dedup


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=6).map(lambda b: bytes(x % 3 for x in b)), max_size=40))
def test_trie_holds_what_is_put_in(texts):
    trie = PatriciaTrie()
    for text in texts:
        node = trie.node(text)
        node[2] = (node[2] or 0) + 1
    assert dict(trie.terminals()) == Counter(texts)
    kept, gone = dict(trie.terminals()), {}
    while some := dict(trie.spill()):
        assert not gone.keys() & some.keys()
        gone |= some
        assert all(trie.leads_out(t) for t in some) and not any(trie.leads_out(t) for t, _ in trie.terminals())
    assert {**gone, **dict(trie.terminals())} == kept
    assert len(dict(trie.terminals())) == min(1, len(kept))


def expected_groups(rows, largest=True):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").translate(ASCII_LOWER)].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = (max(known) if largest else min(known)) if known else None
        digest = hashlib.sha256(text.encode()).hexdigest()
        kept = ids.index(keep)
        out += [(i, keep, len(ids), at == kept, digest) for at, i in enumerate(ids)]
    return sorted(out, key=str)


def grouped(frame):
    return sorted([(r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in frame.collect()], key=str)


def test_dedup_of_odd_rows(odd, nothing):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert grouped(dedup_exact(odd, keep="largest")) == expected_groups(rows)
    assert grouped(dedup_exact(odd)) == expected_groups(rows, largest=False)
    assert dedup_exact(nothing).count() == 0
    with pytest.raises(ValueError):
        dedup_exact(odd, keep="first")


@pytest.mark.parametrize("bound", [1, 3000, 1 << 20])
def test_dedup_with_spills_full_filter_and_colliding_hashes(spark, bound, monkeypatch):
    import strataflow.llm.exact_dedup as module

    # All texts share one hash, so that length and bytes alone tell them apart.
    monkeypatch.setattr(module.F, "xxhash64", lambda *_: module.F.lit(77).cast("long"))
    texts = [f"{'common start ' * 3}{c} {i % 7}" for c in "abC" for i in range(20)] + ["Hot Text"] * 60 + ["HOT TEXT"] * 5 + [None, ""]
    rows = list(enumerate(texts)) + [(5, "hot text"), (None, "hot text")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = grouped(dedup_exact(frame, keep="largest", filter_words=1, trie_bytes=bound))
    assert got == expected_groups(rows)


# Filter audit


def brute_audit(rows, quality, toxic):
    fails, by_text = [], defaultdict(list)
    for doc_id, text, lang in rows:
        if doc_id is not None:
            by_text[text or ""].append(doc_id)
    for doc_id, text, lang in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        bad = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": doc_id is not None and min(by_text[text]) < doc_id,
        }
        fails.append((lang or "", doc_id, {f for f in FILTERS if bad[f]}))
    out = {}
    for part in {p for p, _, _ in fails}:
        shapley, cells = Counter(), {}
        for order in permutations(FILTERS):
            left = [(i, b) for p, i, b in fails if p == part]
            gone = []
            for step, f in enumerate(order, 1):
                here, stay = [x for x in left if f in x[1]], [x for x in left if f not in x[1]]
                shapley[f] += len(here)
                cells["".join(order), step] = [
                    len(stay), len(here), sum(f in b for _, b in gone), sum(b == {f} for p, _, b in fails if p == part),
                    sum(i in quality for i, _ in here), sum(i in toxic for i, _ in here),
                ]
                left, gone = stay, gone + here
        out |= {(part, o, s): (*v, shapley[o[s - 1]]) for (o, s), v in cells.items()}
    return out


def audited(frame):
    return {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in frame.collect()}


def test_removal_steps_are_the_first_failing_position():
    steps = removal_steps(np.arange(32))
    for o, order in enumerate(permutations(range(5))):
        for mask in range(32):
            assert steps[mask, o] == next((i for i, f in enumerate(order) if mask >> f & 1), 5)


def test_text_mask_counts_code_points_and_ascii_space():
    assert text_mask(b"") == 1
    assert text_mask("x y z".encode()) == 1
    assert text_mask(("A" + "é" * 40).encode()) == 1 and text_mask(("A" + "é" * 30).encode()) == 5
    assert text_mask(b"a " * 300) == 2 and text_mask(b" ".join(b"w%d" % i for i in range(200))) == 0
    assert text_mask(b"a\x0bb\x0cc | d") & 8


def test_audit_of_odd_rows_is_as_by_hand(spark, odd, nothing, labels):
    own = [
        (20 + i, text, lang)
        for i, (text, lang) in enumerate(
            [("Copy me 1", "en")] * 4 + [("Copy me 1", "de")] * 2 + [("#" + " w" * 300, "en"), ("w " * 250, "de"), (" ".join(map(str, range(250))), "fr")] * 2
        )
    ] + [(None, "Copy me 1", "en"), (20, "Copy me 1", "en")]
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in odd.collect()] + own
    documents = odd.unionByName(spark.createDataFrame(own, "doc_id long, text string, lang string"), allowMissingColumns=True)
    found = labels.collect()
    quality = {r["doc_id"] for r in found if r["quality"] == 1 and r["doc_id"] is not None}
    toxic = {r["doc_id"] for r in found if r["toxic"] == 1 and r["doc_id"] is not None}
    assert audited(audit_filters(documents, labels.unionByName(labels))) == brute_audit(rows, quality, toxic)
    assert audit_filters(nothing, labels).count() == 0
    assert audited(audit_filters(odd, labels.limit(0))).keys() == audited(audit_filters(odd, labels)).keys()


# Collocations


def brute_phrases(rows, least, top):
    n, f = Counter(), Counter()
    first = {}
    for doc_id, text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(ASCII_LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                for at in range(len(words) - size + 1):
                    key = lang, tuple(words[at : at + size])
                    f[key] += 1
                    if doc_id is not None:
                        first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for lang in n:
        scored = []
        for (l_, words), a in f.items():
            if l_ != lang or len(words) < 2 or a < least:
                continue
            if any(
                g == lang and len(longer) > len(words) and b >= least and 100 * b >= 80 * a
                and any(longer[i : i + len(words)] == words for i in range(len(longer)))
                for (g, longer), b in f.items()
            ):
                continue
            cuts = [(2_000_000 * a // (f[lang, words[:k]] + f[lang, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]], first.get((lang, words))))
        for rank, (score, a, phrase, l, r, doc) in enumerate(sorted(scored)[:top], 1):  # noqa: E741
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score, doc))
    return sorted(out)


def mined(frame):
    names = ("lang", "rank", "phrase", "a", "l", "r", "n", "score", "first_doc")
    return sorted(tuple(r[c] for c in names) for r in frame.collect())


def phrase_rows():
    rng = np.random.default_rng(5)
    words = np.array(["New", "york", "city", "of", "the", "big", "été", "x", "日本", "a b"])
    texts = [" ".join(rng.choice(words, 30, p=[0.2, 0.15, 0.15, 0.1, 0.1, 0.06, 0.06, 0.06, 0.06, 0.06])) for _ in range(40)]
    texts += ["New York  City,of\tthe.big x\nNew york"] * 12 + ["the the the the the the"] * 9
    rows = [(i if i % 5 else None, t, ["en", "de", None, "und"][i % 4]) for i, t in enumerate(texts)]
    return rows + [(1, None, "en"), (2, "", None), (3, "., ;\n", "fr")]


def test_phrases_are_as_by_hand(spark, nothing):
    rows = phrase_rows()
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    for least, top in ((4, 2000), (9, 3)):
        assert mined(mine_phrases(frame, least=least, top=top)) == brute_phrases(rows, least, top)
    assert mine_phrases(nothing).count() == 0


def test_phrases_of_odd_rows(odd):
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in odd.collect()]
    got = mined(mine_phrases(odd, least=2))
    assert got == brute_phrases(rows, 2, 2000) and got


def test_small_chunks_and_a_full_filter_change_nothing(spark, monkeypatch):
    rows = phrase_rows()
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    assert mined(mine_phrases(frame, least=4, bits=64)) == brute_phrases(rows, 4, 2000)


def chunk_of(rows):
    return collocations.read_chunk([t.translate(ASCII_LOWER).encode() for _, t, _ in rows], [g for _, _, g in rows], [d for d, _, _ in rows])


@pytest.mark.parametrize("buckets", [1, 5, 2**60])
def test_collisions_are_told_apart_by_the_text(monkeypatch, buckets):
    rows = [(i, t, g or "und") for i, t, g in phrase_rows() if t]
    plain = collocations.mix
    # Fingerprints of words and phrases that fall into a few values.
    monkeypatch.setattr(collocations, "mix", lambda h: plain(h) % np.uint64(buckets))
    chunk, vocabulary = chunk_of(rows), collocations.Vocabulary()
    ids = vocabulary.ids(chunk, chunk.starts(1))
    codes = np.arange(len(chunk.langs))
    for n in range(1, 5):
        whole = collocations.occurrences(chunk, ids, codes, chunk.starts(n), n)
        # Put together of two halves of the occurrences, too.
        halves = [collocations.occurrences(chunk, ids, codes, chunk.starts(n)[i::2], n) for i in range(2)]
        both = collocations.Counted.joined(halves).added_up()
        told = []
        for some in (whole, both):
            got = {}
            for words, code, count, doc in zip(some.words.tolist(), some.lang.tolist(), some.count.tolist(), some.doc.tolist()):
                key = chunk.langs[code], b" ".join(vocabulary.words[w] for w in words)
                assert key not in got
                got[key] = count, (None if doc == collocations._NONE else doc)
            told.append(got)
        assert told[0] == told[1]
        got = told[0]
        wanted, docs = Counter(), {}
        for doc, text, lang in rows:
            for piece in re.split(rb"[.,;:!?\x0A-\x0D]", text.translate(ASCII_LOWER).encode()):
                words = re.findall(rb"[^\x20\x09]+", piece)
                for at in range(len(words) - n + 1):
                    key = lang, b" ".join(words[at : at + n])
                    wanted[key] += 1
                    if doc is not None:
                        docs[key] = min(doc, docs.get(key, doc))
        assert got == {k: (c, docs.get(k)) for k, c in wanted.items()}


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2**48 - 1), st.integers(1, 2**40)), max_size=60), st.sampled_from([1, 16, 4096]))
def test_blocks_of_counts_come_back(rows, buckets):
    keys = np.array([k for k, _ in rows], np.uint64)
    summed = collocations.add_up(keys, np.array([c for _, c in rows], np.int64))
    back = [collocations.unpack(b, block, buckets) for b, block in collocations.pack(*summed, buckets)]
    got = {k: c for keys, counts in back for k, c in zip(keys.tolist(), counts.tolist())}
    wanted = Counter()
    for key, count in rows:
        wanted[key] += count
    assert got == wanted


def test_counts_are_handed_on_in_parts(spark, monkeypatch):
    rows = phrase_rows()
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(2)
    monkeypatch.setattr(collocations, "HELD", 50)
    monkeypatch.setattr(collocations, "CHUNK", 300)
    assert mined(mine_phrases(frame, least=4)) == brute_phrases(rows, 4, 2000)


def test_long_texts_are_cut_at_pieces(monkeypatch):
    import pyarrow as pa

    text = ("one two three. " * 50 + "four five six " * 9 + "\n").encode() * 3
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["en"]), pa.array([text])], ["doc_id", "lang", "text"])
    whole = next(collocations.chunks([batch]))
    monkeypatch.setattr(collocations, "CHUNK", 40)
    parts = list(collocations.chunks([batch]))
    assert len(parts) > 20
    for n in range(1, 5):
        count = lambda chunk: Counter(chunk.phrase(i, n) for i in chunk.starts(n))
        assert sum(map(count, parts), Counter()) == count(whole)


def test_totals_count_every_word(spark):
    frame = spark.createDataFrame([(1, "a b. c", "en"), (2, "a", None)], "doc_id long, text string, lang string")
    _, totals = count_phrases(frame, least=1)
    assert {r["lang"]: r["n"] for r in totals.collect()} == {"en": 3, "und": 1}
