"""The corpus pipeline against a plain version of every stage, and on odd tables."""

from __future__ import annotations

import math
from collections import Counter
from hashlib import md5, sha256

import pytest

import corpus_pipeline
from telmart.llm import language_id
from telmart.llm.queries import ORACLES, QUERIES
from tests.conftest import SF_DIR
from tests.llm.test_operators import components_of, encoding, none, odd, plain_simhash  # noqa: F401

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def plain_mix(rows):
    """Copies of each (doc_id, text, source), by the rule of the mixing stage."""
    size = {k: len((t or "").encode().split()) for k, (_, t, _) in enumerate(rows)}
    sources = sorted({s for _, _, s in rows}, key=lambda s: (s is None, s or ""))
    held = {s: [k for k, r in enumerate(rows) if r[2] == s] for s in sources}
    total = {s: sum(size[k] for k in held[s]) for s in sources}
    weight = {s: (5, 2, 1)[n % 3] for n, s in enumerate(sources)}
    fixed, target = {}, {}
    while True:
        left, free = sum(total.values()) - sum(fixed.values()), [s for s in sources if s not in fixed]
        target = {**fixed, **{s: left * weight[s] / sum(weight[f] for f in free) for s in free}}
        above = [s for s in free if target[s] > 3 * total[s]]
        if not above:
            break
        fixed |= {s: 3 * total[s] for s in above}
    copies = {}
    for s in sources:
        rate = target[s] / total[s] if total[s] else 0.0
        shift = int(md5(f"mix:{s or ''}".encode()).hexdigest()[:8], 16) / 2**32
        for r, k in enumerate(sorted(held[s], key=lambda k: (size[k], rows[k][0])), 1):
            copies[k] = math.floor(r * rate + shift) - math.floor((r - 1) * rate + shift)
    return copies


def test_pipeline_equals_brute_force(spark, encoding):  # noqa: F811
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "source").collect()]
    slots = language_id._slot_table()
    rows = [r for r in rows if any(slots[ord(c)] for c in (r[1] or "").lower())]
    largest = {}
    for r in rows:
        largest[r[1]] = max(r, largest.get(r[1], r))
    rows = sorted(largest.values())
    codes = [plain_simhash(t) for _, t, _ in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if (codes[a] ^ codes[b]).bit_count() <= 4]
    first = components_of([r[0] for r in rows], links)
    rows = [r for k, r in enumerate(rows) if first[k] == r[0]]
    want: Counter = Counter()
    for k, n in plain_mix(rows).items():
        ids = encoding.encode_ordinary(rows[k][1])
        named = sha256(" ".join(map(str, ids)).encode()).hexdigest()
        want[(rows[k][0], len(ids), named, sha256(rows[k][1].encode()).hexdigest())] += n
    found = Counter(tuple(r) for r in corpus_pipeline.run(spark, SF_DIR).collect())
    assert found == +want


def test_stages_take_odd_and_empty_tables(spark, odd, none):  # noqa: F811
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "exact_dedup", "near_dedup", "mixing", "tokens"]
    for table in (odd, none, odd.select(*COLUMNS)):
        docs = table
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF_DIR)
            assert docs.columns == table.columns
        tokens = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
        assert tokens.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        assert (tokens.count() > 0) == (table is not none)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_sql(spark, name):
    from checks.compare import duckdb_rows, spark_rows

    assert spark_rows(QUERIES[name](spark, SF_DIR)) == duckdb_rows(ORACLES[name], SF_DIR)
