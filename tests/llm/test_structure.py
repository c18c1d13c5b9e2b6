"""Repair of conversations."""

import itertools
import random
import re

import brute
import pytest
from data import FOLDER, rows

from paddock.llm import queries, structure_repair

SCHEMA = "conv_id long, turn long, role string, text string"


def expected(chats: list[tuple]) -> dict:
    return {k: brute.repaired(v) for k, v in brute.damage(chats).items()}


def test_whole_table_against_search(spark):
    chats = rows("SELECT conv_id, turn, role, text FROM conversations")
    found = queries.QUERIES["op11_structure_repair"](spark, FOLDER).collect()
    assert {r.conv_id: tuple(r)[1:] for r in found} == expected(chats)
    assert len({r.audit for r in found}) > 10


def odd_chats(count: int, longest: int, seed: int) -> list[tuple]:
    pick = random.Random(seed)
    roles = ["system", "user", "assistant", "assistant", "user", "tool", "uncle", "", "System"]
    texts = ["one.", "two!", "three?", "cut", "", " \n", "cut. ", "x. ", "a.\t\x0b", "one."]
    return [(k, pick.choice([n, n, n, n // 2, None]), pick.choice(roles[:5] if k % 2 else roles), pick.choice(texts[:4] if k % 2 else texts))
            for k in range(count) for n in range(pick.randint(1, longest))]


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_pieces_against_search(spark, size):
    chats = odd_chats(120, 14, size)
    df = spark.createDataFrame(chats, SCHEMA).repartition(4)
    total, kept = structure_repair.repair(structure_repair.damaged(df), piece_rows=size)
    digest = {r.conv_id: r.repaired_sha256 for r in structure_repair.digests(kept).collect()}
    found = {r.conv_id: (*tuple(r)[1:], digest.get(r.conv_id, brute.sha(""))) for r in total.collect()}
    assert found == {k: v for k, v in expected(chats).items() if brute.damage(chats)[k]}


def test_one_long_conversation_in_many_tasks(spark):
    chats = [(7, n, "assistant" if n % 2 else "user", f"text {n}" + "." * (n % 5 > 0)) for n in range(3000)] + odd_chats(20, 5, 9)[:40]
    df = spark.createDataFrame([(k, t, r, x) for k, t, r, x in chats if k != 8], SCHEMA)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    found = {r.conv_id: tuple(r)[1:] for r in structure_repair.repaired_after_damage(df).collect()}
    pieces = structure_repair.pieces(structure_repair._rows(df, "conv_id"), 100).where("conv = 7").select("number").collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found == expected([r for r in chats if r[0] != 8])
    assert len({r.number >> 33 for r in pieces}) > 1 and len(pieces) >= 30


def test_least_audit_of_all():
    """The parser against all strings of edits on short conversations."""
    parse, prices = structure_repair.repairer(), {"K": 0, "R": 1, "D": 2}
    for initials in itertools.chain.from_iterable(itertools.product("sua", repeat=n) for n in range(4)):
        for cut in itertools.product((structure_repair.SOUND, structure_repair.CUT_OFF, structure_repair.DUPLICATE), repeat=len(initials)):
            best = None
            for letters in itertools.product("KRD", repeat=len(initials)):
                if any(f == structure_repair.DUPLICATE and x != "D" for f, x in zip(cut, letters)):
                    continue
                price = sum(prices[x] + 5 * (f == structure_repair.CUT_OFF and x != "D") for f, x in zip(cut, letters))
                for inserts in itertools.product(range(3), repeat=len(initials) + 1):
                    if sum(inserts) > 2:
                        continue
                    # Choices by place: what is inserted and given a role is either of two.
                    audit, shape = "I" * inserts[0], ["[ua]"] * inserts[0]
                    for i, x, more in zip(initials, letters, inserts[1:]):
                        audit += x + "I" * more
                        shape += ([i] if x == "K" else ["[ua]"] if x == "R" else []) + ["[ua]"] * more
                    fits = any(all(re.fullmatch(p, c) for p, c in zip(shape, w)) for w in words(len(shape)))
                    if fits and (best is None or (price + 5 * sum(inserts), audit) < best):
                        best = (price + 5 * sum(inserts), audit)
            assert parse.finished(parse.parsed([*zip(initials, cut)])) == best


def words(n: int) -> list[str]:
    """The words of the grammar of n letters."""
    return ["ua" * (n // 2)] if n % 2 == 0 else ["s" + "ua" * (n // 2)] if n > 1 else []


def test_edge_rows(spark):
    odd = [(None, None, None, None), (None, 1, "user", "x."), (None, 2, "assistant", "y."), (1, 0, "user", "same."), (1, 0, "user", "same."),
           (1, 1, "assistant", "fine."), (2, None, "assistant", ""), (3, 0, "user", "long " * 20_000 + "."), (3, 1, "assistant", "short!"),
           (4, -5, "user", "q?"), (4, 9, "assistant", "a."), (5, None, "user", "late."), (5, None, "assistant", "early.")]
    df = spark.createDataFrame([(*r, 1, 2, "z") for r in odd], SCHEMA + ", number long, conv int, audit string")
    found = {r.conv_id: tuple(r)[1:] for r in structure_repair.repaired_after_damage(df).collect()}
    assert found == expected(odd)
    assert structure_repair.repaired_after_damage(df.limit(0)).collect() == []
    total, kept = structure_repair.repair(df)
    plain = {r.conv_id: r.cost for r in total.collect()}
    assert plain[1] == 2 and plain[3] == 0 and len(kept.where("conv_id = 1").collect()) == 2
    same = [(1, 0, "user", "one.")] * 2500 + [(1, 1, "assistant", "two.")]
    total, kept = structure_repair.repair(spark.createDataFrame(same, SCHEMA))
    r = total.collect()[0]
    assert (r.duplicate, r.cost, r.audit) == (2499, 4998, "K" + "D" * 2499 + "K") and kept.count() == 2


def test_grammar_whose_tops_cannot_be_merged():
    with pytest.raises(ValueError):
        structure_repair.Repair((("C", "sBa"), ("C", "uBb"), ("B", "xy")))
