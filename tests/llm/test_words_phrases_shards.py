"""Spelling variants, collocations and shards on odd tables and against plain versions."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from telmart.llm import collocations, sharding, spelling
from telmart.llm.common import bitmap, in_bitmap
from telmart.scratch import scratch_path
from tests.conftest import SF_DIR

LONG = " ".join(f"wordly{'abcdefgh'[i % 8]} than" for i in range(20_000))
ODD_SCHEMA = "doc_id long, text string, lang string, source string, word string, n long, place long, key long, at string, __row int"
ODD_TEXTS = [
    (1, "Lettering lettering LETTERING"), (2, "lettering letterinG"), (2, "lettering letterinG"), (3, None), (4, ""),
    (5, " \t\n "), (6, LONG), (7, LONG), (None, "lettering of null"), (None, "lettering of null"), (None, None),
    (8, "Größere größere größere größere größere grössere a.b,c;d:e!f?g\nh"), (9, "é" * 70_000), (10, "x" * 5_000),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [
        (i, t, [None, "en", "de"][k % 3], [None, "a", "b", "a"][k % 4], "w", 1, 2, 3, "4", 5)
        for k, (i, t) in enumerate(ODD_TEXTS)
    ]
    return spark.createDataFrame(rows, ODD_SCHEMA)


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_bitmaps_never_miss_a_key(spark):
    rng = np.random.default_rng(3)
    keys = rng.integers(-(1 << 62), 1 << 62, 500)
    held = bitmap(spark.createDataFrame([(int(k),) for k in keys], "key long"), 1 << 16)
    assert len(held) == 1 << 13
    assert in_bitmap(held, keys).all()
    assert in_bitmap(held, rng.integers(-(1 << 62), 1 << 62, 500)).mean() < 0.1
    assert not in_bitmap(bitmap(spark.createDataFrame([], "key long"), 1 << 16), keys).any()


# Spelling


def plain_words(rows, least_chars=6, least_count=5):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least_chars and n >= least_count}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def edits(word, letters):
    for k in range(len(word) + 1):
        yield from (word[:k] + c + word[k:] for c in letters)
        if k < len(word):
            yield word[:k] + word[k + 1 :]
            yield from (word[:k] + c + word[k + 1 :] for c in letters)


def plain_groups(counts, ratio=5):
    letters, forms, out = sorted(set("".join(counts))), {}, {}
    for word, n in counts.items():
        near = {x for x in edits(word, letters) if x != word and x in counts}
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        forms[word] = best if best is not None and counts[best] >= ratio * n else None
        out[word] = [forms[word], None, n, len(near), counts[best] if forms[word] else None]
    for word in out:
        root = word
        while forms[root]:
            root = forms[root]
        out[word][1] = root
    return {(w, *v) for w, v in out.items()}


def groups_of(words, **options):
    return {
        tuple(r) for r in spelling.variant_groups(words, **options).select("word", "form", "root", "n", "n_near", "form_n").collect()
    }


def test_words_equal_a_plain_count(docs, odd, none):
    for frame in (docs, odd):
        rows = [tuple(r) for r in frame.select("doc_id", "text").collect()]
        for least in (1, 5):
            found = {r["word"]: r["n"] for r in spelling.vocabulary(frame, least_count=least).collect()}
            assert found == plain_words(rows, least_count=least)
    assert spelling.vocabulary(none).count() == 0


def test_variants_equal_brute_force(docs):
    words = spelling.vocabulary(docs, least_count=2)
    assert groups_of(words) == plain_groups({r["word"]: r["n"] for r in words.collect()})


@pytest.mark.parametrize("crowd", [1, 3, 64])
def test_crowded_reduced_words_lose_no_pair(spark, crowd):
    rng = random.Random(7)
    counts = {}
    while len(counts) < 600:
        word = "".join(rng.choice("abcdefghij") for _ in range(rng.choice((4, 5, 6))))
        counts[word] = rng.choice((5, 6, 30, 200, 1500, 9000))
    for k in range(40):  # all in one reduced word if the letters share a symbol
        counts["zzzz" + chr(0xC0 + k)] = 5 + k
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert groups_of(words, crowd=crowd) == plain_groups(counts)
    # A bitmap that lets everything pass changes nothing.
    assert groups_of(words, crowd=crowd, bits=1 << 15) == plain_groups(counts)


def test_roots_follow_long_chains(spark):
    chain = {"a" * (6 + k): 5 * 2**k for k in range(11)}
    words = spark.createDataFrame(list(chain.items()), "word string, n long")
    found = groups_of(words, ratio=2)
    assert found == plain_groups(chain, ratio=2)
    assert {r[2] for r in found} == {"a" * 16}
    with pytest.raises(ValueError):
        spelling.variant_groups(words, ratio=1)


def test_neighbourhood_is_every_one_edit_word_once():
    symbols = {c: chr(0x21 + k) for k, c in enumerate("abc")}
    key = spelling.word_keys(3)
    for word in ("abc", "aabb", "cccc", "a"):
        code = "".join(symbols[c] for c in word)
        letters = np.array([[ord(c) - 0x21 for c in code]])
        hashes = np.concatenate([h for _, h in spelling.neighbourhoods(letters, spelling._codes(3))])
        wanted = {"".join(symbols[c] for c in x) for x in edits(word, "abc")} | {code}
        assert len(hashes) == len(set(hashes.tolist()))
        nonempty = sorted(key(pd.Series(sorted(x for x in wanted if x))).to_numpy().view(np.uint64).tolist())
        assert [h for h in sorted(hashes.tolist()) if h in set(nonempty)] == nonempty
        assert len(hashes) == len(wanted)


def test_spelling_of_odd_tables(odd, none):
    found = {r["word"]: r for r in spelling.variant_groups(spelling.vocabulary(odd)).collect()}
    assert found["lettering"]["n"] >= 5 and found["lettering"]["root"] == "lettering"
    assert "x" * 5_000 not in found  # once only
    empty = spelling.variant_groups(spelling.vocabulary(none))
    assert empty.count() == 0 and empty.columns == ["word", "form", "root", "n", "n_near", "form_n"]


# Collocations


def plain_collocations(rows, least, top, contained=100):
    n, f = Counter(), defaultdict(Counter)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", lowered(text)):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 6):
                f[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = set()
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        held = set()
        for p, a in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    q = p[i : i + size]
                    if 100 * a >= contained * candidates[q]:
                        held.add(q)
        found = []
        for p, a in candidates.items():
            if p not in held:
                cuts = [(1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return out


def found_in(frame, **options):
    return {tuple(r) for r in collocations.collocations(frame, **options).collect()}


@pytest.mark.parametrize("budget", [40, 700, 1 << 20])
def test_collocations_equal_brute_force(docs, budget):
    """Small budgets extend prefixes, to full depth where passages repeat; the result stays."""
    rows = [tuple(r) for r in docs.select("lang", "text").collect()]
    assert found_in(docs, least=8, top=300, budget=budget) == plain_collocations(rows, 8, 300)


def test_containment_share_and_ties(spark):
    lines = [f"alpha beta gamma{' delta' * (k % 4 > 0)}. one two. two one" for k in range(20)]
    frame = spark.createDataFrame([(k, t, None) for k, t in enumerate(lines)], "doc_id long, text string, lang string")
    rows = [(None, t) for t in lines]
    for contained in (50, 75, 100):
        for top in (2, 100):
            assert found_in(frame, least=5, top=top, contained=contained) == plain_collocations(rows, 5, top, contained)


def test_ids_that_meet_are_made_again(docs):
    rows = [tuple(r) for r in docs.limit(3).select("lang", "text").collect()]
    few = docs.sparkSession.createDataFrame([(a, " ".join((b or "").split()[:12])) for a, b in rows], "lang string, text string")
    words, seed = collocations.counted_words(collocations._sources(few, "text", "lang"), id_bits=8)
    assert seed > 0 and words.count() == words.select("id").distinct().count()


def test_products_beyond_64_bits_are_exact(spark):
    big = 7_000_000_011
    phrases = spark.createDataFrame([([1, 2], big, "en", "a b")], "key array<long>, n long, lang string, phrase string")
    counts = spark.createDataFrame([([1], big + 1), ([2], big + 5), ([1, 2], big)], "key array<long>, n long")
    totals = spark.createDataFrame([("en", 9 * big)], "lang string, n long")
    row = collocations.scored(phrases, counts, totals).first()
    assert row["score"] == 1000 * big * 9 * big // ((big + 1) * (big + 5))


def test_blocks_end_at_pieces(monkeypatch):
    monkeypatch.setattr(collocations, "_BLOCK_WORDS", 7)
    batch = pd.DataFrame({"lang": ["en", "de", "en"], "text": ["a b c. d a b\tc, x y", None, "b a!" * 5]})
    said = [[names[k - 1][1] if k else None for k in seq] for seq, names in collocations._blocks(iter([batch]))]
    assert len(said) > 2
    assert [w for s in said for w in s][:12] == [b"a", b"b", b"c", None, b"d", b"a", b"b", b"c", None, b"x", b"y", None]


def test_collocations_of_odd_tables(odd, none):
    rows = [tuple(r) for r in odd.select("lang", "text").collect()]
    assert found_in(odd, least=2, top=50) == plain_collocations(rows, 2, 50)
    empty = collocations.collocations(none)
    assert empty.count() == 0
    assert empty.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


# Shards


def plain_shards(rows, shards):
    """rows: (source, place within the source's shuffle, anything) -> shard and slot by fraction."""
    sizes = Counter(source for source, _ in rows)
    order = sorted(rows, key=lambda r: ((2 * r[1] + 1) / (2 * sizes[r[0]]), r[0] is None, r[0] or "", r[1]))
    out, slots = {}, Counter()
    for place, row in enumerate(order):
        shard = place * shards // len(rows)
        out[row] = (shard, slots[shard])
        slots[shard] += 1
    return out


def test_shards_hold_the_mixture(docs):
    found = sharding.assign(docs).join(docs.select("doc_id", "source", "text"), "doc_id").collect()
    assert len(found) == docs.count()
    counts = Counter(r["shard"] for r in found)
    assert max(counts.values()) - min(counts.values()) <= 1 and sorted(counts) == list(range(8))
    for shard, n in counts.items():
        assert sorted(r["slot"] for r in found if r["shard"] == shard) == list(range(n))
    by_source = Counter(r["source"] for r in found)
    for source, n in by_source.items():
        for shard in counts:
            held = sum(r["source"] == source and r["shard"] == shard for r in found)
            assert abs(held - n * counts[shard] / len(found)) <= 2
    for r in found:
        assert r["size"] == len((r["text"] or "").encode()) + 1
        assert r["checksum"] == zlib.crc32((r["text"] or "").encode())


def test_order_is_the_plain_one(spark, docs):
    facts = docs.select(*sharding._facts(docs, "doc_id", "text", "source"))
    draws = facts.withColumn("draw", F.xxhash64(F.lit(sharding.SEED), "id", "checksum", "size")).collect()
    by_source = defaultdict(list)
    for r in sorted(draws, key=lambda r: (r["draw"], r["id"])):
        by_source[r["source"]].append(r["id"])
    rows = [(source, k) for source, ids in by_source.items() for k in range(len(ids))]
    wanted = {by_source[s][k]: at for (s, k), at in plain_shards(rows, 5).items()}
    found = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.assign(docs, shards=5).collect()}
    assert found == wanted
    # However the rows are dealt, reruns agree.
    again = sharding.assign(docs.repartition(13), shards=5).collect()
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in again} == wanted
    other = sharding.assign(docs, shards=5, seed=99).collect()
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in other} != wanted


def test_shards_of_odd_tables(spark, odd, none):
    found = sharding.assign(odd, shards=4).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(i for i, _ in ODD_TEXTS)
    counts = Counter(r["shard"] for r in found)
    assert max(counts.values()) - min(counts.values()) <= 1
    assert all((r["size"], r["checksum"]) == (1, 0) for r in found if r["doc_id"] in (3, 4))
    assert sharding.assign(none).count() == 0
    few = sharding.assign(odd.limit(3)).collect()  # fewer rows than shards
    assert len({r["shard"] for r in few}) == 3 and all(r["slot"] == 0 for r in few)
    with pytest.raises(ValueError):
        sharding.assign(odd, shards=0)


def test_written_shards_hold_every_row(spark, odd):
    path = scratch_path(spark, "shards")
    sharding.write_shards(odd, path, shards=3)
    parts = [sharding.read_shard(spark, path, k) for k in range(3)]
    assert all(p.columns == odd.columns for p in parts)
    rows = [tuple(r) for p in parts for r in p.collect()]
    assert Counter(rows) == Counter(map(tuple, odd.collect()))
    slots = {(r["shard"], r["slot"]): r["row"]["doc_id"] for r in spark.read.parquet(path).collect()}
    wanted = {(r["shard"], r["slot"]): r["doc_id"] for r in sharding.assign(odd, shards=3).collect()}
    assert slots == wanted


def test_sharding_plan_has_no_python(docs):
    plan = sharding.assign(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
