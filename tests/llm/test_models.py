"""Toxicity, chat formatting, fingerprints."""

import tracemalloc

import brute
import numpy as np
import public_tokenizers
import pytest
from data import FOLDER, documents, rows
from tokenizers import Tokenizer

from paddock.llm import chat_format, fingerprints, queries, toxicity

TEXT = "doc_id long, text string"


@pytest.fixture(scope="module")
def scored(spark):
    larger = "/root/testdata/sf0.01"
    return {r.doc_id: r for r in queries.QUERIES["op5_toxicity"](spark, larger).collect()}


def test_held_out_accuracy(scored):
    import duckdb

    marked = duckdb.sql("""SELECT l.doc_id, toxic, text FROM '/root/testdata/sf0.01/labels.parquet' l
        JOIN '/root/testdata/sf0.01/documents.parquet' d ON d.doc_id = l.doc_id""").fetchall()
    held = [(scored[k], y, t) for k, y, t in marked if brute.fold(k) == 0]
    assert held and all(r.held_out for r, _, _ in held) and not any(scored[k].held_out for k, _, _ in marked if brute.fold(k))
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in scored.values())
    right = np.mean([r.predicted == y for r, y, _ in held])
    assert right >= 0.95
    clean = [r for r, y, _ in held if not y]
    assert np.mean([r.predicted for r in clean]) <= 0.03


def test_toxic_words_decide(scored):
    import duckdb

    words = ("idiot", "moron", "pathetic", "worthless", "disgusting", "clown", "loser", "scum", "trash", "stupid")
    texts = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.01/documents.parquet'").fetchall()
    bad = [k for k, t in texts if any(w in (t or "").lower().split() for w in words)]
    assert np.mean([scored[k].predicted for k in bad]) >= 0.95
    assert np.mean([scored[k].predicted for k, _ in texts if k not in set(bad)]) <= 0.03


def test_toxicity_of_edge_rows(spark):
    texts, labels = ["good words here stay nice"] * 30 + ["vile foul rotten words nasty"] * 10, [0] * 30 + [1] * 10
    model = toxicity.fit(texts, np.array(labels, bool), np.arange(40) % 5)
    edge = brute.edge_rows()
    df = spark.createDataFrame(edge, brute.SCHEMA)
    found = toxicity.toxicity(df, model)
    assert found.count() == len(edge) and found.columns[:5] == df.columns
    assert {r.score for r in found.collect() if not (r.text or "").strip()} == {model.score(0.0)}
    assert toxicity.toxicity(spark.createDataFrame([], brute.SCHEMA), model).collect() == []
    assert toxicity.toxicity(brute.clashing(spark), model).count() == 2
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.toxicity(df, toxicity.learn(df, none)).where("predicted = 1").count() == 0


def digest(turns):
    say = lambda x: "" if x is None else x
    loss = "".join(say(t) for r, t in turns if r == "assistant")
    formatted = sum(len(f"[INST]{chat_format.escaped(say(r))}[/INST]{chat_format.escaped(say(t))}</s>") for r, t in turns)
    return (len(turns), brute.sha("".join(f"{say(r)}\n{say(t)}\n" for r, t in turns)), len(loss), brute.sha(loss), formatted)


def test_conversations_are_read_back(spark):
    expected = {-1: [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]}
    for key, _, role, text in rows("SELECT conv_id, turn, role, text FROM conversations ORDER BY conv_id, turn"):
        expected.setdefault(key, []).append((role, text))
    found = queries.QUERIES["op6_chat_format"](spark, FOLDER).collect()
    assert {r.conv_id: tuple(r)[1:] for r in found} == {k: digest(v) for k, v in expected.items()}


def test_shared_turns_are_written_once(spark):
    chats = {
        1: [("user", "hello there"), ("assistant", "one"), ("user", "more")], 2: [("user", "hello there"), ("assistant", "two")],
        3: [("user", "hello there"), ("assistant", "one"), ("user", "less")], 4: [("user", "hello there"), ("assistant", "one")],
        5: [("system", "x"), ("user", "hello there")], 6: [("user", "hello there"), ("assistant", "one"), ("user", "more")],
        7: [(None, None), ("[INST]", "<\\s></s>[/INST]<s>[\\\\INST] <"), ("assistant", "<|endoftext|> [/INST")],
    }
    turns = [(k, n, r, t, 0) for k, v in chats.items() for n, (r, t) in enumerate(v)]
    nodes, ends = chat_format.format_conversations(spark.createDataFrame(turns, "conv_id long, turn int, role string, text string, start int"))
    table = sorted(nodes.collect(), key=lambda x: x.start)
    assert len(table) == 1 + 2 + 2 + 2 + 3  # hello; one, two; more, less; the others
    assert [x.start for x in table] == list(np.cumsum([0, *(x.n_tokens for x in table[:-1])]))  # one sequence without gaps
    by_start = {x.start: x for x in table}
    for x in table:
        seen, up = [], x
        while up is not None:
            seen[:0] = range(up.start, up.start + up.n_tokens)
            up = by_start.get(up.parent_start)
        assert [p for part in x.attends for p in range(part["from"], part["to"])] == seen
        assert x.position == len(seen) - x.n_tokens
        below = [y for y in table if y is not x and x.start in [p for part in y.attends for p in range(part["from"], part["to"])]]
        assert x.subtree_end == max([x.start + x.n_tokens, *(y.start + y.n_tokens for y in below)])
    leaves = {r.conv_id: r.leaf_start for r in ends.collect()}
    assert leaves[1] == leaves[6] and len(set(leaves.values())) == 6
    found = {r.conv_id: tuple(r)[1:] for r in chat_format.read_back(nodes, ends).collect()}
    assert found == {k: digest(v) for k, v in chats.items()}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert "[INST]user[/INST]hello there</s>" in tokenizer.decode(
        np.frombuffer(b"".join(x["ids"] for x in table), "<u4").tolist(), skip_special_tokens=False)


def test_escapes_are_reversible():
    from itertools import product

    for parts in product(["<", "[", "\\", "s>", "/s>", "INST]", "/INST]", "x"], repeat=4):
        text = "".join(parts)
        hidden = chat_format.escaped(text)
        assert chat_format.unescaped(hidden) == text
        assert not any(c in hidden for c in ("<s>", "</s>", "[INST]", "[/INST]"))


def test_conversations_of_edge_rows(spark):
    schema = "conv_id long, turn long, role string, text string, id int"
    odd = [(None, None, None, None, 1), (None, 1, "user", "x", 1), (1, 0, "user", "same", 1), (1, 0, "user", "same", 1), (2, None, "assistant", "", 1),
           (3, 0, "assistant", "long " * 20_000, 1)]
    found = {r.conv_id: tuple(r)[1:] for r in chat_format.read_back(*chat_format.format_conversations(spark.createDataFrame(odd, schema))).collect()}
    assert found == {None: digest([(None, None), ("user", "x")]), 1: digest([("user", "same")] * 2), 2: digest([("assistant", "")]),
                     3: digest([("assistant", "long " * 20_000)])}
    assert chat_format.read_back(*chat_format.format_conversations(spark.createDataFrame([], schema))).collect() == []


def test_fingerprints_against_next(spark):
    docs = documents()
    found = {r.doc_id: r for r in queries.QUERIES["op10_fingerprints"](spark, FOLDER).collect()}
    maker, errors = fingerprints.Fingerprints(), []
    for k, (key, text) in enumerate(docs):
        text, following = text or "", docs[(k + 1) % len(docs)][1] or ""
        changed = text[:len(text) - len(text) // 4] + following[:len(text) // 4]
        r = found[key]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (len(text), brute.sha(changed), maker.of(text), maker.of(changed))
        assert r.near_next == maker.likeness(maker.of(text), maker.of(following))
        x, y = brute.shingles(text, 5), brute.shingles(changed, 5)
        errors.append(abs(r.near_edited - (len(x & y) / len(x | y) if x | y else 1.0)))
    assert np.mean(errors) < 0.03 and np.max(errors) < 0.2


@pytest.mark.parametrize("bins, bits", [(256, 4), (8, 8), (64, 1), (1024, 2)])
def test_fingerprints_against_plain_version(bins, bits):
    maker = fingerprints.Fingerprints(bins=bins, bits=bits)
    texts = [t for _, t in documents()[:40]] + [t for t in brute.EDGE_TEXTS if len(t or "") < 5000] + ["a", "a b", "A  b", "one two three four five six"]
    for t in texts:
        assert maker.of(t or "") == brute.fingerprint(t, 5, bins, bits)


@pytest.mark.parametrize("partitions", [1, 5])
def test_next_across_tasks(spark, partitions):
    docs = [(k, f"text number {k} " * (k + 1)) for k in range(23)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    found = {r.doc_id: r for r in fingerprints.against_next(spark.createDataFrame(docs, TEXT)).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for k, text in docs:
        assert found[k].edited_sha256 == brute.sha(fingerprints.edited(text, docs[(k + 1) % 23][1]))


@pytest.mark.parametrize("bits", [1, 2, 4, 8])
def test_likeness_is_unbiased(bits):
    maker, r, errors = fingerprints.Fingerprints(width=1, bins=256, bits=bits), np.random.default_rng(bits), []
    for n, shared in ((20, 0), (300, 100), (2000, 1500), (5, 4)):
        for _ in range(12):
            x = [f"w{v}" for v in r.integers(0, 10**9, n)]
            y = x[:shared] + [f"w{v}" for v in r.integers(0, 10**9, n - shared)]
            errors.append(maker.likeness(maker.of(" ".join(x)), maker.of(" ".join(y))) - shared / (2 * n - shared))
    assert abs(np.mean(errors)) < 0.06


def test_fingerprints_of_edge_rows(spark):
    edge = brute.edge_rows()
    df = spark.createDataFrame(edge, brute.SCHEMA)
    found = fingerprints.against_next(df).collect()
    assert len(found) == len(edge) and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    assert len({r.fingerprint for r in found if r.doc_id in (5, 6)}) == 1
    assert fingerprints.against_next(spark.createDataFrame([], brute.SCHEMA)).collect() == []
    assert fingerprints.against_next(brute.clashing(spark)).count() == 2
    one = fingerprints.against_next(df.where("doc_id = 4")).collect()
    assert one[0].near_next == 1.0
    made = df.select(fingerprints.fingerprint(df.text).alias("a")).select(fingerprints.likeness("a", "a").alias("x"))
    assert {r.x for r in made.collect()} == {1.0}


def labelled(n_toxic_words: int, per_text: int, seed: int = 3) -> tuple[list[str], np.ndarray, list[str]]:
    """Ordinary texts, toxic ones with words of their own among ordinary ones, labels, and those words."""
    r = np.random.default_rng(seed)
    usual, foul = [f"{a}{b}o" for a in "bcdfghjklm" for b in ("an", "el", "ir", "os", "um")], [
        f"z{a}{b}{c}x" for a in "abcde" for b in "fghij" for c in "klmnopqrstuvwxyz"][:n_toxic_words]
    texts = [" ".join(f"{a}{b}" for a, b in zip(r.choice(usual, 60), r.choice(usual, 60))) for _ in range(360)]
    toxic = np.arange(360) % 3 == 0
    for n, k in enumerate(np.flatnonzero(toxic)):
        words = texts[k].split()
        for m, at in enumerate(r.choice(60, per_text, replace=False)):
            words[at] = foul[(n * per_text + m) % len(foul)]
        texts[k] = " ".join(words)
    return texts, toxic, foul


def test_toxic_words_in_some_ordinary_rows():
    texts, toxic, foul = labelled(10, 5)
    fresh, labels, _ = labelled(10, 5, seed=4)
    planted = list(texts)
    for n, k in enumerate(np.flatnonzero(~toxic)[:20]):  # each word stands in two ordinary rows
        planted[k] += f" {foul[n % 10]}"
    for some in (texts, planted):
        model = toxicity.fit(some, toxic, np.arange(360) % 5)
        gaps = toxicity._gaps_of(model)
        found = np.array([model.score(toxicity.share_at(gaps.counts(toxicity.words_of(t)), model.gap)) >= 0.5 for t in fresh])
        assert np.mean(found[labels]) >= 0.95 and np.mean(found[~labels]) <= 0.03
        assert len(model.ordinary) == len(model.toxic)


def test_toxic_dictionary_holds_all_learned_words():
    texts, toxic, foul = labelled(400, 30)
    model = toxicity.fit(texts, toxic, np.arange(360) % 5)
    gaps = toxicity._gaps_of(model)
    assert [w for w in foul if max(gaps.counts([w])) <= 0] == []


def test_toxic_words_behind_a_long_beginning(spark):
    texts, toxic, _ = labelled(10, 5)
    long = [(k, f"{'some quiet words first ' * 400}{t}") for k, t in enumerate(texts)]
    df = spark.createDataFrame(long, TEXT)
    marks = spark.createDataFrame([(k, int(y)) for k, y in enumerate(toxic)], "doc_id long, toxic int")
    found = {x.doc_id: x.predicted for x in toxicity.toxicity(df, toxicity.learn(df, marks)).collect()}
    assert np.mean([found[k] == y for k, y in enumerate(toxic)]) >= 0.95


def test_toxicity_fit_holds_each_word_once():
    bodies = [" ".join(f"{chr(97 + k)}{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}xyz" for i in range(500)) for k in range(4)]
    texts = [bodies[k % 4] for k in range(400)]
    marks, folds = np.array([k % 4 == 0 for k in range(400)]), np.array([1 + k // 4 % 4 for k in range(400)])
    tracemalloc.start()
    toxicity.fit(texts, marks, folds)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 25 * 400 * 500  # bytes: a reference a word, not a string


def test_toxicity_remembers_few_windows():
    letters = [chr(97 + k) for k in range(26)]
    words = [f"{a}{b}{c}{d}" for a in letters for b in letters for c in letters for d in letters]
    gaps = toxicity.Gaps(b"some quiet words " * 500, b"other quiet words" * 500, 4, 1)
    tracemalloc.start()
    try:
        for at in range(0, len(words), 400):
            gaps.counts([w.upper() for w in words[at:at + 400]])  # strings of the text's own
        assert tracemalloc.get_traced_memory()[1] < 45e6
    finally:
        tracemalloc.stop()


def test_toxicity_leaves_nothing_in_the_workers(spark):
    texts, toxic, _ = labelled(10, 5)
    model = toxicity.fit(texts, toxic, np.arange(360) % 5)
    df = spark.createDataFrame(list(enumerate(texts)), TEXT).repartition(8, "doc_id")
    assert toxicity.toxicity(df, model).where("windows > 0").count() == 360

    def remembered(batches):
        gaps = toxicity._gaps_of(model)
        for batch in batches:
            yield batch.assign(id=len(gaps.known) + len(gaps.codes))

    left = spark.range(0, 8, 1, 8).mapInPandas(remembered, "id long").collect()
    assert [x.id for x in left] == [0] * 8
