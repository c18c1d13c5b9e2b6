"""Repeated lines, near duplicates, benchmark passages."""

import itertools
import random

import brute
import pytest
from data import FOLDER, documents, rows

from paddock.llm import decontaminate, line_dedup, near_dedup, queries

TEXT = "doc_id long, text string"


def prose(seed: int, n: int) -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choices("abcdefghij", k=r.randint(3, 8))) for _ in range(n)]


def test_lines_against_plain_version(spark):
    r = random.Random(4)
    pool = [" ".join(prose(k, r.randint(1, 9))) for k in range(12)] + ["", "  ", "x"]
    docs = [(k, None if k == 3 else "\n".join(r.choices(pool, k=r.randint(0, 14)))) for k in range(60)]
    found = {x.doc_id: x for x in line_dedup.dedup_lines(spark.createDataFrame(docs, TEXT)).collect()}
    for (key, _), (removed, left) in zip(docs, brute.cut_lines(docs, 10)):
        assert (found[key].n_removed, found[key].text) == (removed, left), key


@pytest.mark.parametrize("copies", [2, 3, 8, 20])
def test_short_lines_go_where_they_stand_often(spark, copies):
    r = random.Random(copies)
    docs = [(k, "\n".join(r.choices([f"w{n}" for n in range(30)] + ["a b", ""], k=r.randint(0, 9)))) for k in range(50)]
    found = {x.doc_id: x for x in line_dedup.dedup_lines(spark.createDataFrame(docs, TEXT), min_copies=copies).collect()}
    for (key, _), (removed, left) in zip(docs, brute.cut_lines(docs, 10, copies)):
        assert (found[key].n_removed, found[key].text) == (removed, left), key
    if copies == 2:
        lines = [x for row in found.values() for x in row.text.split("\n") if x.strip()]
        assert len(lines) == len(set(lines))


def test_lines_of_edge_rows(spark):
    edge = brute.edge_rows()
    df = spark.createDataFrame(edge, brute.SCHEMA)
    found = line_dedup.dedup_lines(df)
    assert found.count() == len(edge) and found.columns == [*df.columns, "n_lines", "n_removed", "removed"]
    # 5 and 6 and the null id have the same line; the null id comes first and keeps it
    assert {x.doc_id: x.n_removed for x in found.collect() if x.text is not None and x.doc_id in (5, 6)} == {5: 1, 6: 1}
    assert line_dedup.without_repeats(df).where("doc_id IN (5, 6)").count() == 0
    assert line_dedup.dedup_lines(spark.createDataFrame([], brute.SCHEMA)).collect() == []
    assert line_dedup.without_repeats(brute.clashing(spark)).count() == 2


def test_passage_of_several_lines(spark):
    passage = "\n".join(" ".join(prose(k, 4)) for k in range(15))  # no line is long enough by itself
    docs = [(k, f"{' '.join(prose(100 + k, 20))}\n{passage}\n{' '.join(prose(200 + k, 20))}") for k in range(4)]
    left = {x.doc_id: x.text for x in line_dedup.without_repeats(spark.createDataFrame(docs, TEXT)).collect()}
    assert left[0] == docs[0][1]
    assert all(passage not in left[k] and len(left[k].split("\n")) == 2 for k in (1, 2, 3))


def copies(seed: int, n_words: int, n_copies: int, changes: int) -> list[str]:
    r, base = random.Random(seed), prose(seed, n_words)
    out = []
    for k in range(n_copies):
        w = list(base)
        for _ in range(changes):
            w[r.randrange(len(w))] = f"new{seed}{k}{r.randrange(999)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("width", [4, 5])
def test_near_duplicates_against_plain_version(spark, width):
    texts = [t for s in range(12) for t in copies(s, 60 + 20 * s, 9, 1 + s % 4)] + ["a b", "A  B", "a", "", None, "a b c d e f g"] * 2
    random.Random(1).shuffle(texts)
    docs = list(enumerate(texts))
    expected = brute.near_components(docs, width)
    found = {x.doc_id: x for x in near_dedup.near_duplicates(spark.createDataFrame(docs, TEXT), width=width).collect()}
    assert {k: found[k].component_id for k in found} == expected
    assert all(found[k].n_shingles == len(brute.shingles(t, width)) and found[k].kept == (expected[k] == k) for k, t in docs)
    left = near_dedup.distinct_documents(spark.createDataFrame(docs, TEXT), width=width)
    assert sorted(x.doc_id for x in left.collect()) == sorted(k for k in expected if expected[k] == k)


@pytest.mark.parametrize("kind", ["replace", "footer", "delete"])
def test_large_groups_with_changes_around_the_limit(spark, kind):
    r, base, docs = random.Random(kind), prose(77, 150), []
    footer = [f"foot{j}" for j in range(24)]
    for k in range(160):
        w = list(base)
        for _ in range(r.randint(0, 9)):
            at = r.randrange(len(w))
            if kind == "delete":
                del w[at:at + r.randint(1, 4)]
            else:
                w[at] = f"new{k}x{r.randrange(999)}"
        docs.append((k, " ".join(w + footer * (kind == "footer" and k % 2))))
    r.shuffle(docs)
    expected = brute.near_components(sorted(docs), 4)
    assert 1 < len(set(expected.values())) < 120
    found = near_dedup.near_duplicates(spark.createDataFrame(docs, TEXT), width=4)
    assert {x.doc_id: x.component_id for x in found.collect()} == expected


def test_chain_of_links(spark):
    base = prose(9, 100)
    docs = [(k, " ".join([*base[k * 2:], *(f"end{j}" for j in range(k * 2))])) for k in range(12)]
    expected = brute.near_components(docs, 5)
    assert set(expected.values()) == {0} and not brute.overlaps(docs[0][1], [(1, "x y z v w")])
    found = near_dedup.near_duplicates(spark.createDataFrame(docs, TEXT))
    assert {x.doc_id: x.component_id for x in found.collect()} == expected


def test_near_duplicates_of_documents(spark):
    docs = documents()
    expected = {docs[k][0]: docs[r][0] for k, r in brute.near_components(docs, 4).items()}
    found = queries.QUERIES["op7_near_dedup"](spark, FOLDER)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert {x.doc_id: x.component_id for x in found.collect()} == expected


def test_near_duplicates_of_edge_rows(spark):
    edge = brute.edge_rows()
    df = spark.createDataFrame(edge, brute.SCHEMA)
    found = near_dedup.near_duplicates(df).collect()
    assert len(found) == len(edge)
    assert {x.component_id for x in found if x.doc_id in (5, 6)} == {5}
    left = near_dedup.distinct_documents(df).collect()
    # one each of: one, the thirteen words, unicode, long, a..., one two; every row without words
    assert len([x for x in left if x.text and x.text.strip()]) == 6
    assert len([x for x in left if not (x.text or "").strip()]) == len([r for r in edge if not (r[1] or "").strip()])
    assert near_dedup.near_duplicates(spark.createDataFrame([], brute.SCHEMA)).collect() == []
    assert near_dedup.distinct_documents(brute.clashing(spark)).columns == brute.clashing(spark).columns


def test_sequential_test_keeps_pairs_at_the_limit():
    steps = near_dedup.least_matches(160, 80, 1e-7)
    r, lost = random.Random(2), 0
    for _ in range(3000):
        hits = [r.random() < 0.8 for _ in range(160)]
        lost += any(sum(hits[:m]) < k for m, k in steps)
    assert lost == 0 and steps[-1][1] > 80


def test_signatures_estimate_similarity():
    signer, hashes = near_dedup.Signer(160), near_dedup.WordHashes()
    a, b = copies(5, 400, 2, 10)
    x, y = (near_dedup.shingle_set(t, 5, hashes) for t in (a, b))
    true = len(set(x) & set(y)) / len(set(x) | set(y))
    same = sum(p == q for p, q in zip(*(memoryview(signer.sign(s)).cast("H") for s in (x, y)))) / 160
    assert abs(true - same) < 0.12


def planted(spark):
    items = [(1, " ".join(prose(1, 40))), (2, " ".join(prose(2, 20))), (3, " ".join(prose(3, 7))), (4, "too short"), (5, None),
             (6, " ".join(prose(6, 5)))]
    part = lambda n, k: " ".join(prose(n, 40)[:k])
    changed = prose(1, 40)
    changed[4::6] = ["other"] * len(changed[4::6])
    docs = [
        (0, f"{part(50, 30)} {items[0][1]} {part(51, 30)}"), (1, f"{part(52, 9)} {' '.join(changed).upper()}, {part(53, 30)}"),
        (2, items[2][1]), (3, f"{part(54, 5)} {items[5][1]}. {part(55, 5)}"), (4, f"{part(56, 40)} too short"), (5, None), (6, ""),
        (7, part(57, 40)), (8, f"{part(58, 11)} {' '.join(prose(2, 20)[3:17])}"), (9, " ".join(prose(1, 40)[:8])), (None, items[1][1]),
        (10, brute.LONG + " " + items[0][1]),
    ]
    return spark.createDataFrame(docs, TEXT), spark.createDataFrame(items, "item_id long, text string"), docs, items


def test_benchmark_passages_against_plain_version(spark):
    df, bench, docs, items = planted(spark)
    found = {x.doc_id: x["items"] for x in decontaminate.decontamination(df, bench).collect()}
    assert found == {k: ",".join(map(str, sorted(brute.overlaps(t, items)))) for k, t in docs}
    assert [found[k] != "" for k in range(10)] == [True, True, True, True, False, False, False, False, True, False]
    assert sorted(x.doc_id for x in decontaminate.clean(df, bench).collect()) == [4, 5, 6, 7, 9]


def test_benchmark_passages_in_documents(spark):
    items = rows("SELECT item_id, text FROM benchmark")
    found = queries.QUERIES["op8_decontamination"](spark, FOLDER).collect()
    docs = documents()
    assert len(found) == len(docs)
    assert {x.doc_id for x in found if x.contaminated} == {k for k, t in docs if brute.overlaps(t, items)}


def test_decontamination_of_edge_rows(spark):
    edge = brute.edge_rows()
    df = spark.createDataFrame(edge, brute.SCHEMA)
    bench = spark.createDataFrame([(1, brute.EDGE_TEXTS[5], 3)], "item_id int, text string, row int")
    assert decontaminate.clean(df, bench).count() == len(edge) - 4
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.clean(df, none).count() == len(edge)
    assert decontaminate.clean(spark.createDataFrame([], brute.SCHEMA), bench).collect() == []
    assert decontaminate.clean(brute.clashing(spark), bench).columns == brute.clashing(spark).columns


@pytest.mark.parametrize("size", range(5, 21))
def test_masks_find_every_placement_of_replacements(size):
    part = min(size, 13)
    masks = decontaminate.masks_for([size], part, 80)[size] if size <= 13 else decontaminate.masks_for([13], 13, 80)[13]
    words, text = [f"w{k}" for k in range(size)], [f"v{k}" for k in range(size)]
    hashes = decontaminate.WordHashes()
    index = {m: decontaminate.seeds(hashes.of(words), m) for m in masks}
    n = 0
    for wrong in range(decontaminate.misses(part, 80) + (size in (14, 15)) + 1):
        for places in itertools.combinations(range(size), wrong):
            changed = [text[k] if k in places else w for k, w in enumerate(words)]
            if not brute.overlaps(" ".join(changed), [(1, " ".join(words))]):
                continue
            n += 1
            assert any((decontaminate.seeds(hashes.of(changed), m) == index[m]).any() for m in masks), places
    assert n >= size


@pytest.mark.parametrize("size, percent", [(20, 80), (40, 70), (13, 50), (26, 4), (9, 30)])
def test_masks_for_other_limits(size, percent):
    r, masks = random.Random(size), decontaminate.masks_for([size], size, percent)[size]
    for _ in range(500):
        changed = set(r.sample(range(size), decontaminate.misses(size, percent)))
        assert any(all(at + k not in changed for k, x in enumerate(m) if x == "1")
                   for m in masks for at in range(size - len(m) + 1)), changed


def test_short_items_and_replaced_words_against_plain_version(spark):
    r, items, docs = random.Random(8), [(n, " ".join(prose(500 + n, n))) for n in (*range(5, 14), 30)], []
    fixed = [(13, (4, 6)), (30, (12, 14, 17)), (8, (3,)), (7, (3,)), (5, (2,)), (12, (3, 8)), (10, (2, 6))]
    for k in range(160):
        n, places = fixed[k] if k < len(fixed) else (r.choice([n for n, _ in items]), None)
        words = dict(items)[n].split()
        for at in places or r.sample(range(n), r.randint(1, 3)):
            words[at] = f"new{k}"
        docs.append((k, " ".join(prose(900 + k, 6) + words + prose(1900 + k, 6))))
    df, bench = spark.createDataFrame(docs, TEXT), spark.createDataFrame(items, "item_id long, text string")
    found = {x.doc_id: x["items"] for x in decontaminate.decontamination(df, bench).collect()}
    assert found == {k: ",".join(map(str, sorted(brute.overlaps(t, items)))) for k, t in docs}


@pytest.mark.parametrize("line, short", [
    ("これは同じ文章が何度も出てくる長い一行です", "短い行です"), ("这是一段在许多文件里反复出现的没有空格的长文字", "短行"),
    ("ข้อความนี้ซ้ำกันในเอกสารหลายฉบับโดยไม่มีช่องว่างเลยสักที่", "สั้น"), ("one\ttwo\tthree\tfour\tfive\tsix\tseven\teight\tnine\tten", "one\ttwo"),
    ("un\u00a0deux\u00a0trois\u00a0quatre\u00a0cinq\u00a0six\u00a0sept\u00a0huit\u00a0neuf\u00a0dix", "un\u00a0deux"), ("ab3/" * 150, "ab3/" * 12),
])
def test_repeated_lines_without_spaces(spark, line, short):
    docs = [(k, f"{prose(k, 1)[0]}\n{line}\n{prose(90 + k, 1)[0]}\n{short}\n{prose(190 + k, 1)[0]}") for k in range(3)]
    found = {x.doc_id: x.removed for x in line_dedup.dedup_lines(spark.createDataFrame(docs, TEXT)).collect()}
    assert found == {0: "", 1: "1-2", 2: "1-2"}
