from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from llm_helpers import collected, documents, workers_find_the_package  # noqa: F401
from millrace.llm.simhash import (block_masks, close_links, fingerprint, simhash_groups, spanning_edges,
                                  without_near_copies)


def plain_print(text: str | None) -> int:
    words = [w for w in (text or "").encode().lower().replace(b"\x1c", b"\x1c").split()]
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(table: list[tuple], max_bits: int = 4) -> dict[int, int]:
    prints = [plain_print(text) for _, text in table]
    root = list(range(len(table)))
    changed = True
    while changed:
        changed = False
        for i in range(len(table)):
            for j in range(len(table)):
                if (prints[i] ^ prints[j]).bit_count() <= max_bits and root[i] != root[j]:
                    root[i] = root[j] = min(root[i], root[j])
                    changed = True
    least = {}
    for (key, _), r in zip(table, root):
        known = least.get(r)
        least[r] = key if known is None else known if key is None else min(key, known)
    return [(key, f"{p:016x}", least[r]) for (key, _), p, r in zip(table, prints, root)]


def near_copies(seed: int = 3) -> list[tuple]:
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    table, key = [], 0
    for _ in range(6):
        base = [rnd.choice(words) for _ in range(rnd.choice([5, 60, 400]))]
        for _ in range(rnd.choice([1, 4, 12])):
            copy = list(base)
            for _ in range(rnd.choice([0, 1, 3])):
                copy[rnd.randrange(len(copy))] = rnd.choice(words)
            key += 1
            table.append((key, rnd.choice([" ", "\n", "  "]).join(copy)))
    return table + [(900, None), (901, ""), (902, " \t"), (903, "One two"), (904, "one TWO"), (904, "one two"),
                    (None, "one two"), (None, "ÉTÉ été"), (905, "a b c d " * 60000)]


@pytest.mark.parametrize("text", [None, "", "One", "a b c", "a b c d", "A B c D e", "é É e", "x " * 70000, "a\x1cb c d e"])
def test_fingerprints(text):
    assert fingerprint(text) == plain_print(text)


def test_groups_like_a_plain_version(documents):
    table = near_copies()
    assert collected(simhash_groups(documents(table))) == sorted(plain_components(table), key=repr)


def test_tiles_and_blocks_do_not_change_components(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 3)
    prints = {int(base[i % 3]) ^ sum(1 << int(b) for b in rng.integers(0, 63, rng.integers(0, 6))) for i in range(400)}
    df = spark.createDataFrame([(p,) for p in prints], "fp long")

    def parts(**options) -> set[frozenset]:
        root = {p: p for p in prints}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x
        for a, b in close_links(df, **options).collect():
            assert (a ^ b).bit_count() <= 64
            root[find(a)] = find(b)
        groups: dict = {}
        for p in prints:
            groups.setdefault(find(p), set()).add(p)
        return {frozenset(g) for g in groups.values()}

    array = np.array(sorted(prints), np.uint64)
    a, b = spanning_edges(array, 4)
    root = dict(zip(a.tolist(), b.tolist()))
    groups: dict = {}
    for p in array.tolist():
        groups.setdefault(root.get(p, p), set()).add(p)
    expected = {frozenset(g) for g in groups.values()}
    assert parts() == parts(tile=16) == parts(blocks=6) == expected


def test_masks_cover_every_close_pair():
    masks = block_masks(7, 4)
    rnd = random.Random(1)
    for _ in range(500):
        flips = sum(1 << bit for bit in rnd.sample(range(64), 4))
        assert any(flips & mask == 0 for mask in masks)


def test_one_document_of_a_group_stays(documents):
    table = near_copies()
    docs = documents(table)
    kept = without_near_copies(docs)
    assert kept.columns == docs.columns
    roots = {row[2] for row in plain_components(table)}
    assert sorted(row["doc_id"] or -1 for row in kept.collect()) == sorted(key or -1 for key in roots)


def test_an_empty_table(documents):
    assert simhash_groups(documents([])).count() == 0
    assert without_near_copies(documents([])).count() == 0
