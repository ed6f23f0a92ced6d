import random

import numpy as np
from claimlens.llm import chunks


def test_hash_is_the_rolling_one():
    raw = np.frombuffer(b"the quick brown fox jumps over the lazy dog" * 3, np.uint8)
    h, out = 0, []
    for b in raw.tolist():
        h = (h << 1) + int(chunks._GEAR[b]) & 0xFFFF
        out.append(h)
    assert chunks.gear_hashes(raw).tolist() == out


def test_passages_over_50_words_are_found(spark, prose):
    shared = [prose(100 + i, 60) for i in range(20)]
    rows = [(i, f"{prose(i, 80)} {shared[i % 20]} {prose(1000 + i, 80)}") for i in range(40)] + [(100 + i, prose(5000 + i, 150)) for i in range(20)]
    got = chunks.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in got} == set(range(40))
    text = dict(rows)
    for r in got:
        span = text[r.doc_id].encode()[r.start : r.end].decode()
        assert len(span.split()) >= 20 and span in text[r.first_doc_id] and r.is_first == (r.first_doc_id == r.doc_id)


def test_within_one_document(spark, prose):
    d = spark.createDataFrame([(1, prose(1, 80) + " " + prose(2, 50) + " " + prose(1, 80))], "doc_id long, text string")
    assert chunks.repeated_passages(d).count() == 0 and chunks.repeated_passages(d, within=True).count() == 2


def test_odd_rows(odd_docs, no_docs):
    got = chunks.repeated_passages(odd_docs).collect()
    assert {r.doc_id for r in got} == {1, 2, None} and len({r.row for r in got}) == 4
    assert sum(r.is_first for r in got) == 1
    assert chunks.repeated_passages(no_docs).count() == 0


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, (r.text or "").split()) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]

    def sharing(k):
        seen = {}
        for i, w in docs:
            for j in range(len(w) - k + 1):
                seen.setdefault(tuple(w[j : j + k]), set()).add(i)
        return {i for s in seen.values() if len(s) > 1 for i in s}

    got = {r.doc_id for r in chunks.op9_substring_dedup(spark, sf).collect()}
    assert sharing(51) <= got <= sharing(18)


def test_every_passage_of_51_words_is_found_to_its_ends(spark):
    """600 passages in contexts of their own; fewer words than 51 are no passage; white space may differ."""
    rng = random.Random(11)
    words = lambda n: ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(1, 9))) for _ in range(n)]
    rows, want = [], {}
    for i in range(600):
        shared = words(51 if i % 10 else 50)
        for k in (0, 1):
            fence = f"fence{2 * i + k}"  # no word beside a passage is shared by chance
            before, after = " ".join([*words(rng.randint(0, 60)), fence, ""]), " ".join([fence, *words(rng.randint(0, 60))])
            middle = (" ", " \n")[k].join(shared)
            if i % 10:
                want[2 * i + k] = (len(before), len(before) + len(middle), 51, 2 * i, k == 0)
            rows.append((2 * i + k, f"{before}{middle} {after}"))
    got = chunks.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.start, r.end, r.words, r.first_doc_id, r.is_first) for r in got} == want and len(got) == len(want)


def test_a_window_holds_its_own_chunk_wherever_it_stands():
    rng = random.Random(3)
    for least in (2, 3, 8, 26, 27, 28, 51, 200):
        words = [rng.choice("ab") if least > 8 and rng.random() < 0.5 else "".join(rng.choice("xyz") for _ in range(rng.randint(1, 9))) for _ in range(600)]
        whole = chunks.Words(" ".join(words)).digests()
        ends, digest, own = whole.chunks(least)
        assert len(own) == 600 - least + 1 and np.diff(ends).max() <= max(1, least // 2)
        for at in range(0, 600 - least, 7):
            alone = chunks.Words(" \n".join(words[at : at + least])).digests()
            e, d, o = alone.chunks(least)
            k = own[at]
            assert d[o[0]] == digest[k] and (e[o[0]] + at, e[o[0] + 1] + at) == (ends[k], ends[k + 1])
            assert at <= ends[k] + 1 and ends[k + 1] < at + least


def test_chunks_vary_and_resist_insertions():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(3000)]
    ends, digest, _ = chunks.Words(" ".join(words)).digests().chunks(51)
    assert len(set(np.diff(ends).tolist())) > 10
    shifted = chunks.Words(" ".join([*words[:1000], "inserted", "words", *words[1000:]])).digests().chunks(51)[1]
    assert len(set(digest.tolist()) - set(shifted.tolist())) <= 6


def test_copies_equal_every_window_listed(spark, prose):
    """Runs, first places and marks against all windows of all rows, with exact copies, near copies and repeated rows."""
    rows = [(9, prose(1, 90)), (3, prose(1, 90)), (3, prose(1, 90)), (4, "lead " + prose(1, 70)), (5, prose(2, 60) + " gap " + prose(1, 90)), (None, prose(2, 60)), (6, prose(2, 60) + " " + prose(3, 20)), (7, prose(4, 200))]
    seen = {}
    for at, (i, t) in enumerate(rows):
        w = t.split()
        for j in range(len(w) - 50):
            seen.setdefault(tuple(w[j : j + 51]), []).append((i is not None, i or 0, at, j))
    want = []
    for at, (i, t) in enumerate(rows):
        w = t.split()
        starts = [j for j in range(len(w) - 50) if len({x[2] for x in seen[tuple(w[j : j + 51])]}) > 1]
        for j in starts:
            if j - 1 not in starts:
                n = next(k for k in range(j, len(w)) if k + 1 not in starts) - j + 1
                places = [min(seen[tuple(w[k : k + 51])]) for k in range(j, j + n)]
                begin = len(" ".join([*w[:j], ""]))
                want.append((i, begin, begin + len(" ".join(w[j : j + n + 50])), n + 50, places[0][1] if places[0][0] else None, all(p[2:] == (at, k) for p, k in zip(places, range(j, j + n), strict=True))))
    got = chunks.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).drop("row").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want)) and len(want) == 8


def test_doc_ids_beside_null_stay_longs(spark, prose):
    big = 2**53 + 1
    docs = spark.createDataFrame([(big, prose(1)), (None, prose(1) + " more"), (big + 1, "other " + prose(1))], "doc_id long, text string").coalesce(1)
    rows = chunks.repeated_passages(docs).collect()
    assert {r.doc_id for r in rows} == {big, None, big + 1}
