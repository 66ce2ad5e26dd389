"""Exact groups by block naming against plain grouping, on awkward rows and small blocks."""

import hashlib
import random

import pytest
from llm_common import importable  # noqa: F401

from ledgerlog.llm import naming

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows):
    groups = {}
    for key, text in rows:
        groups.setdefault((text or "").translate(LOWER), []).append(key)
    out = []
    for key, text in rows:
        low = (text or "").translate(LOWER)
        known = [k for k in groups[low] if k is not None]
        keep = max(known, default=None)
        out.append((key, keep, len(groups[low]), hashlib.sha256(low.encode()).hexdigest()))
    return sorted(out, key=repr)


def table(spark, rows):
    return spark.createDataFrame([(k, t, "x", 1, None) for k, t in rows],
                                 "doc_id bigint, text string, keep_id string, chunk int, kept string")


def check(rows, found):
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=repr) == plain(rows)
    kept = [r for r in found if r.kept]
    assert len({r.text_sha256 for r in kept}) == len(kept) == len({r.text_sha256 for r in found})
    assert all(r.doc_id == r.keep_id for r in kept)


@pytest.mark.parametrize("size,chunk", [(4, 40), (16, 1 << 20), (1024, 8 << 20)])
def test_matches_plain_groups(spark, size, chunk):
    rng = random.Random(size)
    pool = ["", "a", "A", "ab" * 2, "abab" * 2, "abcd", "abcd" * 2, "abcd" * 3, "abcdabc", "x" * 5000, "X" * 4999 + "x",
            "é" * 7, "É" * 7, "\x00", "\x00\x00", " a", "a ", None, "y" * 5000, "x" * 4096 + "z"]
    rows = [(i, rng.choice(pool)) for i in range(300)]
    rows += [(7, "abcd"), (7, "abcd"), (None, "abcd"), (None, "only"), (None, "only"), (-3, "ONLY"),
             (None, "no key"), (None, "NO key"), (2**63 - 1, "edge"), (-2**63, "edge"), (-2**63, "low"), (None, "low")]
    rng.shuffle(rows)
    check(rows, naming.exact_groups(table(spark, rows).repartition(5), size=size, chunk=chunk).collect())


def test_a_third_of_all_rows_is_one_text(spark):
    rows = [(i, "The same long text. " * 300 if i % 3 == 0 else f"{i} " * 50) for i in range(900)]
    check(rows, naming.exact_groups(table(spark, rows).repartition(9), size=64, chunk=4096).collect())


def test_pairs_of_odd_texts_differ(spark):
    """Texts whose blocks are prefixes of one another, in all lengths, stay apart."""
    rows = [(i, "ab" * n) for i, n in enumerate([*range(40), *range(40)])]
    check(rows, naming.exact_groups(table(spark, rows), size=2, chunk=64).collect())


def test_empty(spark):
    out = naming.exact_groups(table(spark, []))
    assert out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"] and out.collect() == []
