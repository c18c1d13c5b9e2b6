"""Near-duplicate documents: MinHash bands propose, a sequential Bayesian test prunes, full shingle sets decide.

Documents with the same shingle set form one class; only classes are signed, banded and compared. In a bucket (the
classes that agree in a band) every class is first paired with the bucket's hub, a class chosen by a hash, so pairs
grow with the rows and not with their square. The links found so are joined to components. Pairs inside one
component can add nothing and are never made. What is left are pairs of different components in one bucket, such as a
large group of copies and copies that have been changed a little too much. There all are compared with one pivot, and only
those that differ from it in the same shingles can be linked (see _around_pivots).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from paddock.llm.common import WordHashes, ascii_words, map_rows, mixed, odd_numbers, remove, shingle_hashes, stored, text_or_empty

BLOCK = 8192  # shingles that are hashed at once
BATCH = 16  # signature values that the sequential test looks at in one step
BITMAP = 4  # longs of a bitmap of differences


def shingle_set(text: str, width: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a text."""
    return np.unique(shingle_hashes(hashes.of(ascii_words(text)), width))


class Signer:
    """MinHash signatures of 16 bits a value."""

    def __init__(self, size: int):
        self.factors = (odd_numbers(size, 11) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
        self.shifts = (odd_numbers(size, 13) >> np.uint64(32)).astype(np.uint32)

    def sign(self, shingles: np.ndarray) -> bytes:
        x = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
        least = None
        for at in range(0, len(x), BLOCK):
            values = np.multiply.outer(self.factors, x[at:at + BLOCK])
            values += self.shifts[:, None]
            block = values.min(axis=1)
            least = block if least is None else np.minimum(least, block)
        return ((least * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype("<u2").tobytes()


def least_matches(size: int, percent: int, miss: float) -> list[tuple[int, int]]:
    """After how many values a pair needs how many matches.

    With every similarity equally likely beforehand, the probability that it is `percent` or more after k matches
    in m values is that of at most k successes in m + 1 trials of that chance. Below `miss` the pair is dropped.
    """
    p = percent / 100
    out = []
    for m in range(BATCH, size + 1, BATCH):
        total, k = 0.0, 0
        while True:
            total += math.comb(m + 1, k) * p ** k * (1 - p) ** (m + 1 - k)
            if total >= miss:
                break
            k += 1
        out.append((m, k))
    return out


def _signed(docs: DataFrame, width: int, size: int, id_column: str, text_column: str) -> DataFrame:
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), text_or_empty(text_column).alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def sign(batches: Iterator[dict[str, list]]) -> Iterator[list[tuple]]:
        hashes, signer = WordHashes(), Signer(size)
        for batch in batches:
            out = []
            for key, text_hash, text in zip(batch["id"], batch["text_hash"], batch["text"]):
                shingles = shingle_set(text, width, hashes)
                signed = (xxhash.xxh3_128_digest(shingles.tobytes()), signer.sign(shingles)) if len(shingles) else (None, None)
                out.append((key, text_hash, len(shingles), *signed))
            yield out

    return map_rows(rows, sign, f"id {id_type}, text_hash long, n long, key binary, signature binary")


def _alike(pairs: DataFrame, classes: DataFrame, size: int, percent: int, miss: float) -> DataFrame:
    """Pairs that the sequential test leaves, with the matches of their whole signatures."""
    tests = least_matches(size, percent, miss)

    def test(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                yield pd.DataFrame({"a": [], "b": [], "matches": []}).astype("int64")
                continue
            left, right = (np.frombuffer(b"".join(batch[c]), "<u2").reshape(-1, size) for c in ("sa", "sb"))
            alive, matches, seen = np.arange(len(batch)), np.zeros(len(batch), np.int64), 0
            for m, least in tests:
                matches[alive] += (left[alive, seen:m] == right[alive, seen:m]).sum(axis=1)
                alive, seen = alive[matches[alive] >= least], m
            yield pd.DataFrame({"a": batch["a"].to_numpy()[alive], "b": batch["b"].to_numpy()[alive], "matches": matches[alive]})

    signatures = classes.select("node", "signature")
    both = (
        pairs.join(signatures.select(F.col("node").alias("b"), F.col("signature").alias("sb")), "b")
        .join(signatures.select(F.col("node").alias("a"), F.col("signature").alias("sa")), "a")
    )
    return both.select("a", "b", "sa", "sb").mapInPandas(test, "a long, b long, matches long")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full shingle sets reach the similarity."""
    def confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["xa"], batch["xb"]):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.loc[np.array(keep, bool), ["a", "b"]]

    both = (
        pairs.select("a", "b").join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("xb")), "b")
        .join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("xa")), "a")
    )
    return both.select("a", "b", "xa", "xb").mapInPandas(confirm, "a long, b long")


def _bitmap(values: np.ndarray) -> list[int]:
    """BITMAP longs in which each value has set one bit."""
    bits = np.zeros(64 * BITMAP, np.uint8)
    bits[(mixed(values) % np.uint64(64 * BITMAP)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.int64).tolist()


def _around_pivots(around: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of nodes around one pivot that may still be linked, and links to the pivot itself.

    `around` has the nodes of every bucket that holds several components, with a pivot of the bucket's
    largest component and each node's own component: outside is whether that is another one. A node outside is not
    linked to the pivot h, or the link is found here. For sets x, y with differences to h of R removed and A added shingles,
    p = percent: a link of x and y needs (100 + p) * shared >= p * (|x| + |y|) + (100 + p) * (Rx + Ry - |h|), where shared
    counts the differences both have. As x is not linked to h, p * |x| + (100 + p) * Rx > 100 * |h|. So y has to
    share at least (p * Ay + 100 * Ry + 1) / (100 + p) of its differences, and x at least (p * |x| + (100 + p) * Rx -
    100 * |h|) / (100 + p). With the differences in one order, the rare ones first, two such nodes have one in common among
    their first |differences| - required + 1: these are joined. The first difference that a pair shares is followed by enough others
    on both sides; other matches are dropped. A bitmap of all differences bounds what a joined
    pair can share, and only pairs that can share enough come out.
    """
    whole = 100 + percent

    def differ(batches: Iterator[dict[str, list]]) -> Iterator[list[tuple]]:
        for batch in batches:
            out = []
            for pivot, node, root, outside, x, h in zip(*(batch[c] for c in ("pivot", "node", "root", "outside", "xb", "xa"))):
                x, h = np.frombuffer(x, "<u8"), np.frombuffer(h, "<u8")
                added, removed = np.setdiff1d(x, h, assume_unique=True), np.setdiff1d(h, x, assume_unique=True)
                a, r = len(added), len(removed)
                near = 100 * (len(h) - r) >= percent * (len(h) + a)
                first = a + r + 1 + (-(percent * a + 100 * r + 1)) // whole
                probes = a + r + 1 - max(1, -((100 * len(h) - percent * len(x) - whole * r) // whole)) if outside and not near else 0
                # shared * whole >= need of x + need of y
                need = percent * len(x) + whole * r - (whole * len(h)) // 2
                differences = np.concatenate([added, removed])
                out.append((pivot, node, root, len(x), outside and near, first, probes, a + r, need, whole * len(h) % 2, _bitmap(differences),
                            differences.astype(np.int64).tolist() if first > 0 or probes > 0 else []))
            yield out

    both = around.join(sets.select("node", F.col("shingles").alias("xb")), "node").join(
        sets.select(F.col("node").alias("pivot"), F.col("shingles").alias("xa")), "pivot")
    nodes = stored(map_rows(
        both, differ, "pivot long, node long, root long, n long, linked boolean, first long, probes long, size long, need long, odd long, "
                      "bits array<long>, differences array<long>"))
    links = nodes.where("linked").select(F.col("pivot").alias("a"), F.col("node").alias("b"))

    bits = [F.col("bits")[k].alias(f"bits{k}") for k in range(BITMAP)]
    each = nodes.select("pivot", "node", "root", "n", "first", "probes", "size", "need", "odd", *bits, F.explode("differences").alias("difference"))
    counts = each.groupBy("pivot", "difference").agg(F.count("*").alias("often")).where("often > 1")
    shared = each.join(counts, ["pivot", "difference"])
    mine = Window.partitionBy("pivot", "node")
    # Differences that no other node has come first and need no row.
    place = F.col("size") - F.count("*").over(mine) + F.row_number().over(mine.orderBy("often", "difference"))
    placed = stored(shared.withColumn("place", place).where("place <= first OR place <= probes"))
    kept = ["node", "root", "n", "size", "need", "place", *(f"bits{k}" for k in range(BITMAP))]

    def side(letter: str) -> DataFrame:
        return placed.where(f"place <= {'probes' if letter == 'x' else 'first'}").select(
            "pivot", "difference", "odd", *[F.col(c).alias(letter + c) for c in kept])

    only = lambda one, other: " + ".join(f"bit_count({one}bits{k} & ~{other}bits{k})" for k in range(BITMAP))
    pairs = side("x").join(side("y").drop("odd"), ["pivot", "difference"]).where(f"""
        xroot <> yroot AND 100 * least(xn, yn) >= {percent} * greatest(xn, yn)
        AND {whole} * (1 + least(xsize - xplace, ysize - yplace)) >= xneed + yneed - odd
        AND {whole} * least(xsize - ({only("x", "y")}), ysize - ({only("y", "x")})) >= xneed + yneed - odd""")
    return pairs.select(F.least("xnode", "ynode").alias("a"), F.greatest("xnode", "ynode").alias("b")).distinct(), links


def components(links: DataFrame) -> DataFrame:
    """node and root (the smallest node reachable) for every node of the links (a, b), by alternating stars.

    Each round hangs every node's larger neighbours, then its smaller ones, on the smallest neighbour. Only
    minima per node are aggregated; neighbours are never gathered. The rounds end when nothing changes.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    before = None
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stored(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(small.select("u", F.col("m").alias("v")))
        after = stored(small.where("u <> v").distinct())
        now = tuple(after.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())
        remove(edges, large)
        edges = after
        if now == before:
            break
        before = now
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _rooted(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """Add the root of each node; a node without links is its own."""
    return nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, bands: int = 32, band_values: int = 5, miss: float = 1e-7,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Group documents whose sets of word shingles have a Jaccard similarity of `percent` or more, directly or in chains.

    Words stand between ASCII white space, A-Z in lower case; a shingle is `width` words, the whole sequence
    where there are fewer. One row per input row, repeated rows included: the id, n_shingles, component_id (the
    smallest id of the group), kept (it is that document), text_hash, first_hash (of the group's first). Texts that are null or have no words have no shingles and
    no links and are kept. A group whose ids are all null has component_id null and all its rows kept; a null id
    beside others is not kept. Two documents at the limit share no band with probability
    (1 - (percent/100)^band_values)^bands, 3e-6 by default, and are pruned with at most `miss` in a step.
    """
    size = bands * band_values
    signed = stored(_signed(docs, width, size, id_column, text_column))
    classes = stored(
        signed.where("key IS NOT NULL").groupBy("key", "n", "signature")
        .agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("first"))
        .select(F.monotonically_increasing_id().alias("node"), "key", "n", "signature",
                F.col("first.id").alias("id"), F.col("first.text_hash").alias("text_hash")))

    bytes_each = 2 * band_values
    bucket = F.expr(
        f"transform(sequence(0, {bands - 1}), i -> xxhash64(substring(signature, i * {bytes_each} + 1, {bytes_each}), i))")
    banded = classes.select("node", "n", F.explode(bucket).alias("bucket"))
    order = F.xxhash64("node", "bucket")
    hubs = banded.groupBy("bucket").agg(
        F.count("*").alias("size"), F.min_by("node", order).alias("hub"), F.min_by("n", order).alias("hub_n")
    ).where("size > 1").drop("size")
    rows = stored(banded.join(hubs, "bucket"))  # classes that share a bucket with another

    sizes_fit = F.expr(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")
    pairs = rows.where("node <> hub").select(
        F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"),
        F.col("n").alias("na"), F.col("hub_n").alias("nb")).where(sizes_fit).select("a", "b").distinct()
    likely = stored(_alike(pairs, classes, size, percent, miss))

    # Full sets, for classes that share a bucket, from one document of each.
    wanted = classes.join(rows.select("node").distinct(), "node", "left_semi").select(
        "node", F.col("id").alias("wanted_id"), F.col("text_hash").alias("wanted_hash"))
    texts = docs.select(F.col(f"`{id_column}`").alias("id"), text_or_empty(text_column).alias("text"))
    texts = texts.join(wanted, F.col("id").eqNullSafe(F.col("wanted_id")) & (F.xxhash64("text") == F.col("wanted_hash")))

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            shingles = [shingle_set(t, width, hashes).astype("<u8").tobytes() for t in batch["text"]]
            yield pd.DataFrame({"node": batch["node"], "shingles": shingles})

    sets = stored(texts.select("node", "text").mapInPandas(gather, "node long, shingles binary").dropDuplicates(["node"]))

    # First the likeliest hub of each class, then what else may join two components, then whole buckets.
    ends = likely.select("a", "b", "matches", F.col("b").alias("node")).unionAll(
        likely.select("a", "b", "matches", F.col("a").alias("node")))
    best = ends.groupBy("node").agg(F.max_by(F.struct("a", "b"), F.struct("matches", F.xxhash64("a", "b"))).alias("pair"))
    links = stored(_linked(best.select("pair.*").distinct(), sets, percent))
    roots = stored(components(links))

    def apart(some: DataFrame) -> DataFrame:
        """Pairs whose ends are in different components so far."""
        at = _rooted(some.withColumnRenamed("a", "node"), roots).select(F.col("node").alias("a"), F.col("root").alias("ra"), "b")
        at = _rooted(at.withColumnRenamed("b", "node"), roots)
        return at.where("ra <> root").select("a", F.col("node").alias("b"))

    links = stored(links.unionAll(_linked(apart(likely.select("a", "b")), sets, percent)))
    roots = stored(components(links))

    members = _rooted(rows.select("bucket", "node"), roots)
    parts = members.groupBy("bucket", "root").agg(F.count("*").alias("rows"))
    several = parts.groupBy("bucket").agg(F.max_by("root", F.struct("rows", "root")).alias("main"), F.count("*").alias("parts")).where("parts > 1")
    # The pivot of a component is the class that is alike to most others, so that differences to it are few.
    ends = likely.where(F.col("matches") * 100 >= percent * size)
    degree = ends.select(F.col("a").alias("node")).unionAll(ends.select(F.col("b").alias("node"))).groupBy("node").agg(F.count("*").alias("degree"))
    pivots = _rooted(degree, roots).groupBy(F.col("root").alias("main")).agg(F.max_by("node", F.struct("degree", "node")).alias("pivot"))
    around = members.join(several.select("bucket", "main"), "bucket").select("main", "node", "root").distinct().join(pivots, "main", "left")
    around = stored(around.select(
        F.coalesce("pivot", "main").alias("pivot"), "node", "root", (F.col("root") != F.col("main")).alias("outside")))
    pairs, found = _around_pivots(around, sets, percent)
    pairs = pairs.join(likely.select("a", "b"), ["a", "b"], "left_anti")  # those have been decided
    links = stored(links.unionAll(found).unionAll(_linked(_alike(pairs, classes, size, percent, miss), sets, percent)))
    roots = components(links)

    labelled = _rooted(classes.select("node", "key", "id", "text_hash"), roots)
    least = labelled.groupBy("root").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("first"))
    by_key = labelled.select("key", "root").join(least, "root").select("key", "first")
    found = signed.select("id", "text_hash", "n", "key").join(by_key, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("first.id"))
    return found.select(
        F.col("id").alias(id_column), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"), "text_hash", F.col("first.text_hash").alias("first_hash"))


def distinct_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The rows of `docs`, unchanged, of which no near duplicate has a smaller id; texts without words stay.

    One row of each group stays: that with the smallest id (null last), then the smallest hash of the text; of rows
    that repeat both, one.
    """
    found = near_duplicates(docs, id_column=id_column, text_column=text_column, **options)
    stays = found.where("kept AND n_shingles > 0 AND text_hash = first_hash").select(
        F.col(id_column).alias("__id"), "text_hash").distinct()
    stays = stays.select(F.xxhash64("__id", "text_hash").alias("__key"), "__id", F.col("text_hash").alias("__hash"))
    key, text = F.col(f"`{id_column}`"), text_or_empty(text_column)
    rows = docs.withColumn("__text", F.xxhash64(text)).withColumn("__key", F.xxhash64(key, "__text"))
    first = rows.join(stays, "__key").where(key.eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__hash")))
    first = first.dropDuplicates(["__key", "__text", "__id"])
    words = F.trim(F.translate(text, "\t\n\x0b\x0c\r", " " * 5)) == ""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return first.select(*columns).unionAll(docs.where(words).select(*columns))
