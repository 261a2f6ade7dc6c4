"""Near duplicates by an LSH forest of MinHash signatures.

Each tree orders the documents by a signature of its own. Documents next to each other with a long enough
common prefix are candidates, and so are the members of small regions, which go as deep as the region
is dense. Links are confirmed on whole shingle sets; equal sets are one class from the start.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placelake.llm.common import Scratch, components, keyed, wrapped
from placelake.llm.words import shingles, word_hashes

_SIGNED = "_id long, _h long, n_shingles long, digest binary, labels array<binary>"


def shingle_set(text: str, size: int) -> np.ndarray:
    """Distinct hashes of the runs of so many words, in order. A-Z count as lower case."""
    return np.unique(shingles(word_hashes(text.encode("utf-8", "surrogatepass").lower()), size))


class Signer:
    """Labels of a set, one per tree: the smallest values of its members under so many hash functions."""

    def __init__(self, trees: int, depth: int, seed: int = 3):
        rng = np.random.default_rng(seed)
        n = trees * depth
        self.trees, self.depth = trees, depth
        self.factors = rng.integers(0, 2**32, n, dtype=np.uint32) | np.uint32(1)
        self.offsets = rng.integers(0, 2**32, n, dtype=np.uint32)

    def labels(self, members: np.ndarray) -> list[bytes]:
        least = np.full(len(self.factors), 2**32 - 1, dtype=np.uint32)
        # Both halves of a member count: the lower one is scaled, the upper one spreads equal lower halves.
        low, high = members.astype(np.uint32), (members >> np.uint64(32)).astype(np.uint32)
        for a in range(0, len(members), 2048):
            x = self.factors[:, None] * low[a:a + 2048] + self.offsets[:, None]
            x ^= x >> np.uint32(15)
            x *= np.uint32(0x2C1B3C6D)
            x ^= high[a:a + 2048]
            x *= np.uint32(0x297A2D39)
            np.minimum(least, x.min(axis=1), out=least)
        rows = least.reshape(self.trees, self.depth).astype(">u4")
        return [row.tobytes() for row in rows]


def signed(rows: DataFrame, shingle: int, trees: int, depth: int) -> DataFrame:
    """Keys, set size, a digest of the set, and the labels. An empty set has no labels."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        signer = Signer(trees, depth)
        for batch in batches:
            out = []
            for i, h, text in zip(batch["_id"], batch["_h"], batch["_text"]):
                members = shingle_set(text, shingle)
                digest = hashlib.blake2b(members.tobytes(), digest_size=16).digest()
                out.append((i, h, len(members), digest, signer.labels(members) if len(members) else []))
            yield pd.DataFrame(out, columns=[x.split()[0] for x in _SIGNED.split(", ")])

    return rows.mapInPandas(run, _SIGNED)


def _prefix(depth: int | Column) -> Column:
    return F.substring("label", 1, 4 * depth)


def _neighbours(heads: bool):
    """Rows in order: each with the one before it, and if wanted with the first of its region, unless their roots are the same."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = head = None
        for batch in batches:
            a, b = [], []
            for tree, prefix, node, root in zip(batch["tree"], batch["prefix"], batch["node"], batch["root"]):
                if last is None or last[:2] != (tree, prefix):
                    head = (node, root)
                else:
                    near = {last[2:], head} if heads else {last[2:]}
                    for other, its_root in sorted(near):
                        if its_root != root:
                            a.append(other); b.append(node)
                last = (tree, prefix, node, root)
            yield pd.DataFrame({"a": np.array(a, dtype=np.int64), "b": np.array(b, dtype=np.int64)})

    return run


def _near_pairs(rooted: DataFrame, heads: bool) -> DataFrame:
    order = ["tree", "prefix", "label", "node"]
    near = (rooted.select(*order, "root").repartitionByRange(*order).sortWithinPartitions(*order)
            .mapInPandas(_neighbours(heads), "a long, b long"))
    return near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _merged(roots: DataFrame, links: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """The roots after further links, from the components of the roots that these join."""
    ends = links
    for end in ("a", "b"):
        ends = ends.join(roots.select(F.col("node").alias(end), F.col("root").alias(f"r{end}")), end, "left")
    ends = ends.select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")).distinct()
    over = scratch.write(components(ends, scratch, label), f"{label}-over")
    moved = roots.join(over.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left")
    moved = moved.select("node", F.coalesce("top", "root").alias("root"))
    return scratch.write(moved.unionByName(over.join(roots, "node", "left_anti")), f"{label}-roots")


def _rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    return rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def regions(forest: DataFrame, scratch: Scratch, least: int, most: int, limit: int) -> DataFrame:
    """Rows of regions with company: those of the prefixes ``least`` deep, and of the regions inside the larger ones.

    Level by level: regions of one row end, those up to the limit are taken, larger ones go deeper, down to
    ``most``. Regions over the limit that are ``least`` deep are taken as well (``dense``), so that rows that part
    further down can still be compared; regions further down are ``deep``.
    """
    rows, taken = forest, None
    for depth in range(least, most + 1):
        counts = rows.groupBy("tree", _prefix(depth).alias("prefix")).agg(F.count("*").alias("n")).filter("n > 1")
        joined = rows.withColumn("prefix", _prefix(depth)).join(counts, ["tree", "prefix"])
        joined = scratch.write(joined, f"level-{depth}")
        done = joined if depth in (least, most) else joined.filter(F.col("n") <= limit)
        done = done.select("tree", "prefix", "label", "node", (F.col("n") > limit).alias("dense"), F.lit(depth > least).alias("deep"))
        taken = done if taken is None else taken.unionByName(done)
        rows = joined.filter(F.col("n") > limit).select("tree", "label", "node")
    return taken


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets (node, members) have 100 * shared >= percent * union."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ok = []
            for x, y in zip(batch["x"], batch["y"]):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.loc[np.array(ok, dtype=bool), ["a", "b"]]

    sized = sets.withColumn("n", F.length("members"))
    left = sized.select(F.col("node").alias("a"), F.col("members").alias("x"), F.col("n").alias("nx"))
    right = sized.select(F.col("node").alias("b"), F.col("members").alias("y"), F.col("n").alias("ny"))
    # Sizes alone rule out many pairs, before the sets move.
    sizes = pairs.join(left.select("a", "nx"), "a").join(right.select("b", "ny"), "b")
    close = sizes.filter(100 * F.least("nx", "ny") >= percent * F.greatest("nx", "ny")).select("a", "b")
    both = close.join(left.select("a", "x"), "a").join(right.select("b", "y"), "b")
    return both.mapInPandas(run, "a long, b long")


def _sets(rows: DataFrame, shingle: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"node": batch["node"], "members": [shingle_set(t, shingle).tobytes() for t in batch["_text"]]})

    return rows.select("node", "_text").mapInPandas(run, "node long, members binary")


def near_duplicates(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                    percent: int = 80, trees: int = 24, least: int = 4, most: int = 8, limit: int = 32) -> DataFrame:
    """A row per distinct (``_id``, ``_h``): n_shingles, component (smallest ``_id`` reachable by links) and joint.

    ``joint`` numbers the components, as two may have a smallest id in common where ids repeat.

    Documents link if 100 times their shared shingles are ``percent`` times the union or more. Candidates come
    in turns. First neighbours in three trees' orders; then, in all trees, neighbours and the first of each region, unless what was
    linked so far has joined them already. Then every region ``least`` deep again, for the pairs that lie in different
    components: all of them in regions up to ``limit`` rows, and in denser ones those that share a rare member, which every pair
    that links does (see ``_by_rare_members``). So no bound on a region drops a pair of it, and rows that part
    at a depth between ``least`` and ``most`` are compared as well: more depth only serves the first turns.

    A pair of similarity s shares a region of depth d in a tree with chance s**d; with 24 trees, depth 4 and
    s = 0.8 a pair is missed in all trees with a chance below 1e-5, as with 16 trees and s = 0.85. Empty sets link with nothing. Null ids
    are below all others; ties are equal rows, which share a result. An empty table gives no rows.
    """
    rows = keyed(docs, id_col, text_col)
    signs = scratch.write(signed(rows, shingle, trees, most).dropDuplicates(["_id", "_h"]), "signs")
    # A class of equal sets is known by its smallest key; writing the classes fixes their numbers.
    full = signs.filter("n_shingles > 0")
    classes = full.groupBy("digest").agg(F.min(F.struct("_id", "_h")).alias("first"))
    classes = scratch.write(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    filled = full.join(classes, "digest")
    firsts = filled.filter(F.struct("_id", "_h") == F.col("first"))
    forest = firsts.select("node", F.posexplode("labels").alias("tree", "label"))
    found = scratch.write(regions(forest, scratch, least, most, limit), "regions")
    scratch.drop(*[f"level-{d}" for d in range(least, most + 1)])

    wanted = found.select("node").distinct().join(classes, "node").select("node", "first._id", "first._h")
    texts = rows.join(wanted, ["_id", "_h"]).dropDuplicates(["node"])
    sets = scratch.write(_sets(texts, shingle), "sets")

    # A few orders' neighbours first: rows of large groups then share a root, and only pairs of other roots go on.
    chains = found.filter(~F.col("deep") & (F.col("tree") < 3)).withColumn("root", F.col("node"))
    links = scratch.write(confirmed(_near_pairs(chains, heads=False), sets, percent), "links-0")
    roots = scratch.write(components(links, scratch, "turn-0"), "roots-0")
    near = scratch.write(_near_pairs(_rooted(found, roots), heads=True), "near")
    roots = _merged(roots, scratch.write(confirmed(near, sets, percent), "links-1"), scratch, "turn-1")

    rest = scratch.write(_apart(found, roots, sets, scratch, percent), "apart")
    more = scratch.write(confirmed(rest, sets, percent), "links-2")
    if more.limit(1).count():
        roots = _merged(roots, more, scratch, "turn-2")
    labelled = filled.select("_id", "_h", "n_shingles", "node").join(roots.withColumnRenamed("root", "joint"), "node", "left")
    labelled = labelled.withColumn("joint", F.coalesce("joint", "node"))
    smallest = labelled.groupBy("joint").agg(F.min("_id").alias("component"))
    linked = labelled.join(smallest, "joint").select("_id", "_h", "n_shingles", "component", "joint")
    empty = signs.filter("n_shingles = 0").select("_id", "_h", "n_shingles", F.col("_id").alias("component"), F.lit(None).cast("long").alias("joint"))
    return scratch.write(linked.unionByName(empty), "result")


def _apart(found: DataFrame, roots: DataFrame, sets: DataFrame, scratch: Scratch, percent: int) -> DataFrame:
    """Pairs of a region that isn't deep whose rows lie in different components so far."""
    rows = _rooted(found.filter("NOT deep"), roots)
    rows = scratch.write(rows.select("tree", "prefix", "node", "root", "dense"), "rooted")
    region = ["tree", "prefix"]
    parts = rows.groupBy(*region, "dense", "root").agg(F.count("*").alias("n"))
    kinds = parts.groupBy(*region, "dense").agg(F.count("*").alias("parts"), F.max(F.struct("n", "root")).alias("main"))
    mixed = kinds.filter("parts > 1").select(*region, F.col("main.root").alias("main"))
    mixed_rows = rows.join(mixed, region)
    small = mixed_rows.filter("NOT dense").groupBy(*region).agg(F.collect_list(F.struct("node", "root")).alias("rows"))
    one = small.select("rows", F.explode("rows").alias("p"))
    two = one.select("p", F.explode(F.filter("rows", lambda q: (q["node"] > F.col("p.node")) & (q["root"] != F.col("p.root")))).alias("q"))
    pairs = two.select(F.col("p.node").alias("a"), F.col("q.node").alias("b"))
    dense = mixed_rows.filter("dense").groupBy("node").agg(F.min("root").alias("root"), F.max(F.col("root") != F.col("main")).alias("outside"))
    far = _by_rare_members(scratch.write(dense, "dense"), sets, scratch, percent)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).unionByName(far).distinct()


def _by_rare_members(nodes: DataFrame, sets: DataFrame, scratch: Scratch, percent: int, held: int = 1 << 17) -> DataFrame:
    """Pairs (a, b) of nodes with other roots, one of them outside, that may link: those that share a rare member.

    In any one order of all members, two sets that link have a member in common among the first n - ceil(percent * n / 100) + 1
    of each, as one shares ``percent`` of its members at least. The order here puts members that many sets hold last, so sets that have no
    more than a template in common do not meet. ``held`` most frequent members are known by their counts, all others stand before them;
    this bounds what the tasks hold and decides costs only, as any order gives every link. A member of many rows is met in blocks.
    """
    full = nodes.join(sets, "node").select("node", "root", "outside", "members")
    tally = full.select("members").mapInPandas(_tallied, "member long, n long").groupBy("member").agg(F.sum("n").alias("n")).filter("n > 1")
    common = tally.orderBy(F.desc("n"), "member").limit(held).toPandas().sort_values("member")
    known = nodes.sparkSession.sparkContext.broadcast((common["member"].to_numpy(np.int64), common["n"].to_numpy(np.int64)))

    def first_ones(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hot, times = known.value
        for batch in batches:
            out, size = [], 0
            for node, root, outside, members in zip(batch["node"], batch["root"], batch["outside"], batch["members"]):
                members = np.frombuffer(members, dtype=np.int64)
                n = len(members)
                often = np.zeros(n, dtype=np.int64)
                if len(hot):
                    at = np.minimum(np.searchsorted(hot, members), len(hot) - 1)
                    often = np.where(hot[at] == members, times[at], 0)
                first = np.lexsort((members, often))[:n + percent * -n // 100 + 1]
                out.append((node, root, outside, n, members[first]))
                size += len(first)
                if size > 1 << 19:
                    yield _unfolded(out)
                    out, size = [], 0
            if out:
                yield _unfolded(out)

    rare = scratch.write(full.mapInPandas(first_ones, "node long, root long, outside boolean, n long, at long, member long"), "rare")
    live = (rare.groupBy("member").agg(F.count("*").alias("rows"), F.max("outside").alias("out"), F.min("root").alias("r"), F.max("root").alias("s"))
            .filter("out AND r != s").select("member", F.ceil(F.col("rows") / 2048).alias("blocks")))
    rows = rare.join(scratch.write(live, "live"), "member")
    left = rows.filter("outside").select("member", *[F.col(c).alias(f"{c}_a") for c in ("node", "root", "n", "at")],
                                         F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    right = rows.select("member", *[F.col(c).alias(f"{c}_b") for c in ("node", "root", "n", "at")],
                        F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block"))
    # Before their first common member neither set has any of the other; what follows bounds what they share.
    most = 1 + F.least(F.col("n_a") - 1 - F.col("at_a"), F.col("n_b") - 1 - F.col("at_b"))
    met = left.join(right, ["member", "block"]).filter(
        (F.col("root_a") != F.col("root_b")) & ((100 + percent) * most >= percent * (F.col("n_a") + F.col("n_b"))))
    return met.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def _unfolded(rows: list[tuple]) -> pd.DataFrame:
    """A row per member, with its place, of rows (node, root, outside, n, members)."""
    nodes, roots, outsides, sizes, members = zip(*rows)
    lengths = [len(m) for m in members]
    whole = {"node": nodes, "root": roots, "outside": outsides, "n": sizes}
    return pd.DataFrame({k: np.repeat(np.array(v), lengths) for k, v in whole.items()} | {
        "at": np.concatenate([np.arange(k) for k in lengths]), "member": np.concatenate(members)})


def _tallied(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        members, n = np.unique(np.frombuffer(b"".join(batch["members"]), dtype=np.int64), return_counts=True)
        yield pd.DataFrame({"member": members, "n": n})


def keep_one(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id, with all its columns.

    Documents without words are no duplicates and stay.
    """
    found = near_duplicates(docs, scratch, id_col, text_col, **options)
    first = (found.filter("n_shingles > 0").groupBy("joint").agg(F.min(F.struct("_id", "_h")).alias("key"))
             .select("key.*", F.lit(True).alias("filled")))
    chosen = first.unionByName(found.filter("n_shingles = 0").select("_id", "_h", F.lit(False).alias("filled")))
    rows = wrapped(docs, id_col, text_col).join(chosen, ["_id", "_h"])
    turn = F.row_number().over(Window.partitionBy("_id", "_h").orderBy("filled"))
    return rows.withColumn("turn", turn).filter("NOT filled OR turn = 1").select("_row.*")
