"""Large groups of near copies and repeated rows: all links kept, work bounded by differences."""

from __future__ import annotations

import random

import pytest

from tidemark.llm import exact_dedup, mixing, ngram_join

SCHEMA = "doc_id long, text string"


def shingles(text):
    words = text.lower().split()
    return {" ".join(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) > 4 else {" ".join(words)} - {""}


def components(rows):
    sets, root = {i: shingles(t) for i, t in rows}, {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1:]:
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(seed, n=300, size=120, most=5, repeats=False):
    """Copies of one text with words changed, dropped and added; some share their changes."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10_000)}" for _ in range(size)]
    rows, kept = [(0, " ".join(base))], []
    for i in range(1, n):
        words = list(rng.choice(kept) if kept and rng.random() < 0.3 else base)
        for _ in range(rng.randint(1, most)):
            k, kind = rng.randrange(len(words)), rng.random()
            new = f"x{rng.randrange(40 if repeats else 100_000)}"
            if kind < 0.6:
                words[k] = new
            elif kind < 0.8:
                words.insert(k, new)
            else:
                del words[k]
        kept.append(words)
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("seed, frequent, repeats", [(1, 64, False), (2, 2, True), (3, 8, False), (4, 2, False)])
def test_all_links_of_a_group_of_near_copies(spark, monkeypatch, seed, frequent, repeats):
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    rows = near_copies(seed, repeats=repeats)
    # a second group, and texts that belong to none
    rows += [(1000 + i, t) for i, t in near_copies(seed + 50, 60, 60, 3)]
    rng = random.Random(seed)
    rows += [(2000 + i, " ".join(f"w{rng.randrange(10_000)}" for _ in range(50))) for i in range(40)]
    want = components(rows)
    assert len({c for _, c in want.values()}) > 60  # many members of the groups are linked with nothing
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_join(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == want


def test_repeated_rows_cost_one_comparison(spark, monkeypatch):
    seen = []
    inner = ngram_join._shingles

    def counted(*args):
        out = inner(*args)
        seen.append((out.count(), out.select("rep").distinct().count()))
        return out
    monkeypatch.setattr(ngram_join, "_shingles", counted)
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words))] * 50 + [(2, " ".join(words[:-1]))] * 40 + [(3, " ".join(words[::-1]))]
    got = ngram_join.ngram_join(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(1, 1)] * 50 + [(2, 1)] * 40 + [(3, 3)]
    assert seen and all(n == distinct for n, distinct in seen)


def test_exact_dedup_takes_the_smallest_id_there_is(spark):
    least = -2 ** 63
    docs = spark.createDataFrame([(least, "a b"), (5, "ab"), (None, "a b"), (7, "x"), (2 ** 63 - 1, "x")], SCHEMA)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(docs).collect()}
    assert got == {least: (least, 3, True), 5: (least, 3, False), None: (least, 3, False), 7: (7, 2, True), 2 ** 63 - 1: (7, 2, False)}
    assert sorted(str(r.doc_id) for r in exact_dedup.drop_exact_duplicates(docs).collect()) == ["-9223372036854775808", "7"]


def test_slots_are_filled_by_as_many_tasks_as_shards(spark):
    slots = mixing._slots(spark, [(5000, 2000), (3000, 3000)], 1, 1000)
    assert slots.rdd.getNumPartitions() == 8 and slots.count() == 8000


def test_many_sources_are_joined(spark):
    docs = spark.createDataFrame([(i, "word " * (1 + i % 5), f"s{i % 700}") for i in range(3000)], "doc_id long, text string, source string")
    got = mixing.mix_sources(docs).collect()
    assert len(got) == 3000 and all(r.taken <= 3 * r.size for r in got)
    assert abs(sum(r.taken for r in got) - sum(r.size for r in got)) <= 64 * 700
