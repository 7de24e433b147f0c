"""Links between fingerprints against all pairs of them."""

import random

import pytest

from quarry.llm import simhash
from quarry.llm.components import components

from . import brute


def signed(f):
    return f - (1 << 64) if f >> 63 else f


def crowd():
    """Fingerprints at one to four bits' distance, bit 63 among them, whole upper halves turned, and shared halves."""
    rng, out = random.Random(7), set()
    for _ in range(40):
        f = rng.getrandbits(64)
        out |= {f, f ^ (0xFFFFFFFF << 32)}
        for bits in range(1, 5):
            for top in (False, True):
                flips = set(rng.sample(range(63), bits - top)) | ({63} if top else set())
                out.add(f ^ sum(1 << b for b in flips))
    half = rng.getrandbits(32)
    return sorted(out | {half | rng.getrandbits(32) << 32 for _ in range(60)} | {half << 32 | 1 << b for b in range(20)} | {0, 1 << 63, 7})


@pytest.mark.parametrize("bucket", (3, 4096))
def test_links_join_what_all_pairs_join(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    prints = crowd()
    fps = spark.createDataFrame([(signed(f),) for f in prints], "fp long")
    root = {r.node: r.root for r in components(simhash.links(fps)).collect()}
    found, expected = {}, {}
    for f, least in brute.classes({f: f for f in prints}).items():
        found.setdefault(root.get(signed(f), signed(f)), set()).add(f)
        expected.setdefault(least, set()).add(f)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, expected.values()))
    assert any(len(c) > 1 and len({f >> 63 for f in c}) == 2 for c in expected.values())


def test_distances_are_those_of_unsigned_numbers():
    for bits in ({63, 0}, {63, 62, 0}, {63}, set(range(61, 64))):
        other = sum(1 << b for b in bits)
        assert len(simhash.spanning_links([0, signed(other)])) == 1
    assert simhash.spanning_links([5, signed(5 ^ (0xFFFFFFFF << 32))]) == []


def test_components_where_near_links_exist(spark):
    rows = simhash.op3_simhash(spark, "/root/testdata/sf0.1").collect()
    prints = {r.doc_id: int(r.fingerprint, 16) for r in rows}
    assert {r.doc_id: r.component_id for r in rows} == brute.classes(prints)
    assert len({r.component_id for r in rows}) < len(set(prints.values()))  # some links are between different ones


def test_ids_of_any_type(spark):
    docs = spark.createDataFrame([("b", "one text here"), ("a", "one text here"), (None, "another text altogether"), ("c", None)], "doc_id string, text string")
    found = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert found == {("b", "a"), ("a", "a"), (None, None), ("c", "c")}
