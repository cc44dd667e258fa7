"""Operator 6, n-gram Jaccard join: a parity-sketch join.

Each shingle flips one bit of a sketch, so two sketches differ in at most as many bits as their sets have elements not
shared. Sets with a Jaccard similarity of at least t have at most d = (1 - t) / (1 + t) * (|A| + |B|) of those; with
sketches cut into more than d blocks, such a pair agrees on a whole block. Sets are dealt to bands of similar size, since
d grows with size; a set near the top of its band is entered into the next one as well. The join is exact at every
threshold.

1. Equal sets are one class, with a number of its own. Each class enters its blocks as bucket keys; a block's key is the
   XOR of the hashes of its shingles, the fingerprint of a sketch as wide as there are hashes. Sketches have a few blocks
   more than d + 1, so that up to as many empty ones, on which many sets agree, need not be entered. Buckets of one class go.
2. In a bucket, pairs whose short sketches (again a lower bound) differ in more than d bits go; what is left connects
   classes to provisional components. No pair above the threshold is lost by either bound.
3. Within a provisional component, pairs are verified on the sets themselves, nearest sketches first and only while
   they would connect something new.

Buckets and components, however large, are compared in shares of bounded size, see spanning(): most of a group of near
copies connects within shares, and only what is then still apart from its largest part is compared with all of it. No
step writes out all pairs; links() does, between classes, for those who ask for them.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm import common, components, shingles

THRESHOLD = Fraction(90, 100)
WORDS = 3
#: Of near-duplicate stages: five words, four fifths.
STAGE_THRESHOLD, STAGE_WORDS = Fraction(80, 100), 5
BAND = 1.2
#: Sets of at least WIDE_FROM elements have a second, wider sketch, as the short one is full of ones and zeros then.
SHORT_BITS, WIDE_BITS, WIDE_FROM = 1024, 8192, 1000
#: Rows of a share of a bucket and of a component, and rows of all shares that a task compares.
BUCKET_SHARE, SET_SHARE, BUCKET_TASK, SET_TASK = 512, 128, 4096, 64
#: Fingerprints that a task remembers, to leave out copies.
HAD_SETS = 200_000


def most_apart(total, t: Fraction = THRESHOLD):
    """The most elements that sets of together `total` elements at or above t do not share."""
    a, b = (1 - t).as_integer_ratio(), (1 + t).as_integer_ratio()
    return total * (a[0] * b[1]) // (a[1] * b[0])


def band_of(n: int) -> int:
    return int(math.log(n) / math.log(BAND) + 1e-9)


def band_edge(band: int) -> int:
    """The least size in a band."""
    n = max(1, int(BAND**band) - 1)
    while band_of(n) < band:
        n += 1
    return n


@lru_cache(maxsize=None)
def blocks_in(band: int, t: Fraction) -> tuple[int, int]:
    """Blocks of the sets of a band, and how many of them may be left out: with d elements not shared by the largest
    sets, d + 1 blocks and as many more as the smallest set is likely to leave empty."""
    apart, least = most_apart(2 * (band_edge(band + 1) - 1), t), band_edge(band)
    m = apart + 1
    if m < 8 or least < 3 * m:
        return m, 0
    empty = m * math.exp(-least / m)
    spare = math.ceil(1.2 * empty + 2 * math.sqrt(empty))
    return m + spare, spare


def bands_for(n: int, t: Fraction) -> list[int]:
    """Its own band, and each above that holds sets it may be similar to."""
    band, top = band_of(n), int(n / t)
    return list(range(band, max(band, band_of(top)) + 1))


def block_keys(h: np.ndarray, band: int, t: Fraction) -> np.ndarray:
    """Bucket keys of a set in a band: the XOR of each block's hashes, with block and band. As similar sets agree on more
    blocks than may be left out, empty ones are, if they are not more."""
    m, spare = blocks_in(band, t)
    block = (h >> np.uint64(32)) % np.uint64(m)
    words = np.zeros(m, np.uint64)
    np.bitwise_xor.at(words, block.astype(np.int64), shingles.mix(h ^ shingles.PLACES[11]))
    places = np.arange(m, dtype=np.uint64) * np.uint64(1 << 16) + np.uint64(band)
    if (words == 0).sum() <= spare:
        words, places = words[words != 0], places[words != 0]
    return shingles.mix(shingles.mix(places + shingles.PLACES[12]) ^ (words * shingles.PLACES[0]))


def sketch(h: np.ndarray) -> bytes:
    """The short sketch, and the wide one of a large set."""
    out = b""
    for bits in (SHORT_BITS, WIDE_BITS)[: 1 + (len(h) >= WIDE_FROM)]:
        odd = np.bincount(((h >> np.uint64(16)) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
        out += np.packbits(odd.astype(np.uint8)).tobytes()
    return out


def fingerprint(h: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed numbers."""
    a = np.bitwise_xor.reduce(shingles.mix(h * shingles.PLACES[13])) if len(h) else np.uint64(0)
    b = shingles.mix(h ^ shingles.PLACES[14]).sum(dtype=np.uint64)
    return int(np.asarray(a, np.uint64).view(np.int64)), int(b.view(np.int64))


def similar(a: np.ndarray, b: np.ndarray, t: Fraction) -> bool:
    """Whether the Jaccard similarity of two sorted sets is at least t, in whole numbers."""
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int((b[at] == a).sum())
    return t.denominator * both >= t.numerator * (len(a) + len(b) - both)


class Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def sketch_all(docs: DataFrame, words: int) -> DataFrame:
    """row (its number), doc_id, text_key (a hash of id and text), n, s1, s2 (fingerprint) and sketch of every row, written
    to the shared folder."""
    names = ["doc_id", "text_key", "n", "s1", "s2", "sketch"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, prints, sketches = [], [], []
            for h in shingles.shingle_sets(batch.column(1).to_pylist(), words):
                sizes.append(len(h))
                prints.append(fingerprint(h))
                sketches.append(sketch(h))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(sizes, pa.int64()),
                    pa.array([p for p, _ in prints], pa.int64()),
                    pa.array([p for _, p in prints], pa.int64()),
                    pa.array(sketches, pa.binary()),
                ],
                names=names,
            )

    schema = "doc_id long, text_key long, n long, s1 long, s2 long, sketch binary"
    rows = docs.select(F.col("doc_id").cast("long"), "text", text_key()).mapInArrow(run, schema)
    return common.materialize(rows.withColumn("row", F.monotonically_increasing_id()), "sketches")


def text_key() -> Column:
    return F.xxhash64(F.col("doc_id").cast("long"), "text", F.col("doc_id").isNull()).alias("text_key")


def first_rows(rows: DataFrame, *by: str) -> DataFrame:
    """For each value of `by` its least doc_id (null last), of its rows the text_key of one and how many rows have this id
    and text, and as node the number of one of its rows. Copies are counted before they meet in one task."""
    counted = rows.groupBy(*by, "doc_id", "text_key").agg(F.min("row").alias("row"), F.count("*").alias("rows"))
    head = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key", "rows")).alias("head")
    return counted.groupBy(*by).agg(head, F.min("row").alias("node")).select(
        *by, "node", F.col("head.doc_id").alias("least"), F.col("head.text_key").alias("text_key"), F.col("head.rows").alias("rows")
    )


class Sketches:
    """The sketches of a group of sets, and which pairs they and the sizes allow."""

    def __init__(self, column, n: np.ndarray):
        rows, self.n = list(column), n
        short = SHORT_BITS // 8
        self.short = np.frombuffer(b"".join(r[:short] for r in rows), np.uint64).reshape(len(rows), -1)
        wide = np.flatnonzero(n >= WIDE_FROM)
        self.at = np.full(len(rows), -1)
        self.at[wide] = np.arange(len(wide))
        self.wide = np.frombuffer(b"".join(rows[i][short:] for i in wide), np.uint64).reshape(len(wide), WIDE_BITS // 64)

    def near(self, i: np.ndarray, j: np.ndarray, t: Fraction) -> tuple[np.ndarray, np.ndarray]:
        """Whether each of the pairs (i, j) may be similar, and in how many bits its sketches differ."""
        n = self.n
        apart = np.bitwise_count(self.short[i] ^ self.short[j]).sum(1, dtype=np.int64)
        lo, hi, most = np.minimum(n[i], n[j]), np.maximum(n[i], n[j]), most_apart(n[i] + n[j], t)
        ok = (apart <= most) & (lo * t.denominator >= hi * t.numerator)
        both = np.flatnonzero(ok & (self.at[i] >= 0) & (self.at[j] >= 0))
        if len(both):
            a, b = self.at[i[both]], self.at[j[both]]
            apart[both] = np.bitwise_count(self.wide[a] ^ self.wide[b]).sum(1, dtype=np.int64)
            ok[both] = apart[both] <= most[both]
        return ok, apart


def compare(group: pd.DataFrame, unit: list[str], t: Fraction, every: bool) -> pd.DataFrame:
    """Links (u, v) between the rows of each unit (node, n, sketch, and set, label, rest where they matter).

    Without sets the pairs that may be similar, with sets those that are; pairs with one label, and pairs of which neither
    is in the rest, are left out. With every all links, else as many as connect the same.
    """
    group = group.drop_duplicates([*unit, "node"]).sort_values([*unit, "node"], ignore_index=True)
    code = group.groupby(unit, sort=False).ngroup().to_numpy()
    node, sketches = group["node"].to_numpy(), Sketches(group["sketch"], group["n"].to_numpy())
    label = group["label"].to_numpy() if "label" in group else None
    rest = group["rest"].to_numpy() if "rest" in group else None
    left, right, apart = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for o in range(1, len(group)):
        same = code[:-o] == code[o:]
        if not same.any():
            break
        if label is not None:
            same &= label[:-o] != label[o:]
        if rest is not None:
            same &= rest[:-o] | rest[o:]
        i = np.flatnonzero(same)
        if len(i):
            ok, differ = sketches.near(i, i + o, t)
            left.append(i[ok])
            right.append(i[ok] + o)
            apart.append(differ[ok])
    left, right, apart = np.concatenate(left), np.concatenate(right), np.concatenate(apart)
    if "set" not in group:
        if every:
            return pd.DataFrame({"u": node[left], "v": node[right]})
        known = components.least_labels(len(group), left, right)
        other = known != np.arange(len(group))
        return pd.DataFrame({"u": node[other], "v": node[known[other]]}).drop_duplicates()
    order = np.argsort(apart, kind="stable")
    sets = [np.frombuffer(x, np.uint64) for x in group["set"]]
    union, u, v = Union(len(group)), [], []
    for i, j in zip(left[order].tolist(), right[order].tolist(), strict=True):
        if (every or union.find(i) != union.find(j)) and similar(sets[i], sets[j], t):
            union.join(i, j)
            u.append(node[i])
            v.append(node[j])
    return pd.DataFrame({"u": np.array(u, np.int64), "v": np.array(v, np.int64)})


LINKS = "u long, v long"


def within_shares(rows: DataFrame, total: int, share: int, task: int, salt: int, t: Fraction) -> DataFrame:
    """Links that connect what is linked within shares: each group (group, m: its rows) is dealt by salt to shares of about
    `share` rows, tasks hold about `task` rows, of `total`, of shares of small and large groups."""
    own = F.pmod(F.xxhash64(F.lit(salt), "node"), F.expr(f"(m + {share - 1}) div {share}"))
    bins = max(1, -(-total // task))
    dealt = rows.withColumn("share", own).withColumn("bin", F.pmod(F.xxhash64("group", "share"), F.lit(bins)))
    return dealt.drop("m").groupBy("bin").applyInPandas(lambda g: compare(g, ["group", "share"], t, False), LINKS)


def across_shares(rows: DataFrame, share: int, t: Fraction, every: bool) -> DataFrame:
    """Links between the rows of each group of which `rest` is true (label, rest) and all its others, by pairs of shares
    in separate tasks."""
    sizes = rows.groupBy("group").agg(F.count("*").alias("m"), F.count_if("rest").alias("k"))
    sizes = sizes.filter("k > 0").select(
        "group", F.expr(f"(m + {share - 1}) div {share}").alias("shares"), F.expr(f"(k + {share - 1}) div {share}").alias("parts")
    )
    dealt = rows.drop("m").join(sizes, "group").withColumn("share", F.pmod(F.xxhash64(F.lit(11), "node"), F.col("shares")))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64(F.lit(12), "node"), F.col("parts")))
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    all_ = dealt.withColumn("part", upto("parts"))
    some = dealt.filter("rest").withColumn("share", upto("shares"))
    unit = ["group", "share", "part"]
    both = all_.unionByName(some).drop("shares", "parts")
    return both.groupBy(*unit).applyInPandas(lambda g: compare(g, unit, t, every), LINKS)


def spanning(rows: DataFrame, share: int, task: int, t: Fraction, attach: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Links (u, v) that connect whatever is linked within the groups of a written table rows (group, m: its rows, node, n);
    attach adds sketches, and sets if links are to be verified, to some of them.

    Groups of one share are compared at once. Larger ones are dealt to shares twice, by different hashes: of a group of
    copies that connects nearly all. What is then not connected with the group's largest part is compared with all of
    it, so no link is lost, and the work grows with the square of what is left only.
    """
    links = common.materialize(within_shares(attach(rows), rows.count(), share, task, 21, t).distinct(), "links")
    large = rows.filter(F.col("m") > share)
    if not (total := large.count()):
        return links
    links = common.materialize(links.union(within_shares(attach(large), total, share, task, 22, t)).distinct(), "links")
    labels = common.materialize(components.connected_components(links), "labels")
    named = large.join(labels, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component")
    parts = named.groupBy("group", "label").agg(F.count("*").alias("k"))
    core = parts.groupBy("group").agg(F.max_by("label", F.struct("k", "label")).alias("core"))
    apart = parts.join(core, "group").filter("label <> core").select("group", "core").distinct()
    rest = named.join(apart, "group").withColumn("rest", F.col("label") != F.col("core")).drop("core")
    rest = common.materialize(rest, "rest")
    return links if rest.isEmpty() else links.union(across_shares(attach(rest), share, t, False)).distinct()


def bucket_rows(docs: DataFrame, t: Fraction, words: int) -> DataFrame:
    """group (a bucket key) and s1 (half a fingerprint) for each key of each row's set; a task leaves out sets that it has
    had. Keys are made from the texts a second time: they are several times as large as all else, and so only travel
    to where buckets are formed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        had: set[tuple[int, int]] = set()
        for batch in batches:
            keys, prints, size = [], [], 0
            for h in shingles.shingle_sets(batch.column(0).to_pylist(), words):
                own = fingerprint(h)
                if not len(h) or own in had:
                    continue
                if len(had) >= HAD_SETS:
                    had.clear()
                had.add(own)
                for band in bands_for(len(h), t):
                    found = block_keys(h, band, t)
                    keys.append(found)
                    prints.append(np.full(len(found), own[0], np.int64))
                    size += len(found)
                if size >= 1 << 17:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(prints))], names=["group", "s1"])
                    keys, prints, size = [], [], 0
            if size:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(prints))], names=["group", "s1"])

    return docs.select("text").mapInArrow(run, "group long, s1 long")


def provisional_links(docs: DataFrame, classes: DataFrame, sketched: DataFrame, t: Fraction, words: int) -> DataFrame:
    """Links that connect classes which share a bucket and whose sketches are near enough."""
    w = Window.partitionBy("group")
    rows = bucket_rows(docs, t, words).withColumns({"lo": F.min("s1").over(w), "hi": F.max("s1").over(w)})
    # Two classes whose s1 is equal by chance only share more buckets than they should.
    shared = common.materialize(rows.filter("lo <> hi").select("group", "s1").distinct(), "buckets")
    shared = shared.join(classes.select("s1", "node", "n"), "s1").withColumn("m", F.count("*").over(w)).drop("s1")
    sketches = sketched.select(F.col("row").alias("node"), "sketch")
    return spanning(common.materialize(shared, "shared"), BUCKET_SHARE, BUCKET_TASK, t, lambda rows: rows.join(sketches, "node"))


def with_sets(docs: DataFrame, members: DataFrame, words: int) -> DataFrame:
    """members (group, m, node, n, s1, s2, sketch, text_key) with the set of each, read off a text of its class, written to
    the shared folder: texts travel once. Of rows that repeat a text a task keeps one."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        had: set[int] = set()
        for batch in batches:
            column = lambda c: batch.column(batch.schema.get_field_index(c)).to_pylist()  # noqa: B023, E731
            fresh = [i for i, node in enumerate(column("node")) if node not in had and not had.add(node)]
            batch = batch.take(pa.array(fresh, pa.int64()))
            text, s1, s2 = column("text"), column("s1"), column("s2")
            found = list(shingles.shingle_sets(text, words))
            # Texts of other sets whose keys are equal by chance go.
            at = [i for i, h in enumerate(found) if fingerprint(h) == (s1[i], s2[i])]
            had.difference_update(set(column("node")) - {column("node")[i] for i in at})
            kept = batch.select(["group", "m", "node", "n", "sketch"]).take(pa.array(at, pa.int64()))
            hashes = pa.array([found[i].tobytes() for i in at], pa.binary())
            yield pa.RecordBatch.from_arrays([*kept.columns, hashes], names=[*kept.schema.names, "set"])

    rows = docs.select(text_key(), "text").join(members, "text_key")
    rows = rows.mapInArrow(sets, "group long, m long, node long, n long, sketch binary, set binary")
    return common.materialize(rows, "sets")


def sketched_classes(docs: DataFrame, words: int) -> tuple[DataFrame, DataFrame]:
    """Every row (see sketch_all) and the classes of equal sets (see first_rows)."""
    sketched = sketch_all(docs, words)
    return sketched, common.materialize(first_rows(sketched.filter("n > 0"), "n", "s1", "s2"), "classes")


def candidates(docs: DataFrame, sketched: DataFrame, classes: DataFrame, t: Fraction, words: int) -> DataFrame:
    """Classes in provisional components of several: all of first_rows, sketch, group (the component) and m (its size)."""
    near = components.connected_components(provisional_links(docs, classes, sketched, t, words))
    near = common.materialize(near, "near")
    sizes = near.groupBy(F.col("component").alias("group")).agg(F.count("*").alias("m"))
    members = classes.join(near.withColumnRenamed("component", "group"), "node").join(sizes, "group")
    members = members.join(sketched.select(F.col("row").alias("node"), "sketch"), "node")
    return common.materialize(members, "members")


def joined_rows(docs: DataFrame, t: Fraction, words: int) -> DataFrame:
    """row, doc_id, text_key, n_shingles, component (null for empty sets) and component_id of each row."""
    sketched, classes = sketched_classes(docs, words)
    members = candidates(docs, sketched, classes, t, words)
    sets = with_sets(docs, members, words)
    payload = sets.select("node", "sketch", "set")
    small, large = (members.filter(f"m {sign} {SET_SHARE}").select("group", "m", "node", "n") for sign in ("<=", ">"))
    links = within_shares(sets.filter(F.col("m") <= SET_SHARE), small.count(), SET_SHARE, SET_TASK, 21, t)
    if not large.isEmpty():
        more = spanning(large, SET_SHARE, SET_TASK, t, lambda rows: rows.join(payload, "node"))
        links = links.union(more)
    labels = components.connected_components(links)
    same = classes.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = same.groupBy("component").agg(F.min("least").alias("component_id"))
    same = same.join(named, "component").select("n", "s1", "s2", "component", "component_id")
    # Numbers of classes are in no order of ids: a component is named by the least id of its classes.
    found = sketched.select("row", "doc_id", "text_key", "n", "s1", "s2").join(same, ["n", "s1", "s2"], "left")
    name = F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("row", "doc_id", "text_key", F.col("n").alias("n_shingles"), "component", name.alias("component_id"))


def join_documents(docs: DataFrame, t: Fraction = THRESHOLD, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of docs (doc_id, text; other columns are ignored).

    component_id is the least doc_id reachable by links, where rows link whose sets of shingles have a Jaccard
    similarity of at least t. Null or empty texts, and texts of white space, have empty sets and link with nothing. Rows
    that repeat an id are documents of their own, each with the links of its text; a null id has a null component_id
    unless it is linked with a document that has an id.
    """
    return joined_rows(docs, t, words).select("doc_id", "n_shingles", "component_id")


def links(docs: DataFrame, t: Fraction = THRESHOLD, words: int = WORDS) -> DataFrame:
    """All links between different sets: id_a, id_b (the least ids of two classes of equal sets, null where all its ids
    are) and rows_a, rows_b (their documents). Equal documents are linked without being listed.

    This compares all pairs of a provisional component whose sketches allow it, in shares; join_documents doesn't.
    """
    sketched, classes = sketched_classes(docs, words)
    members = candidates(docs, sketched, classes, t, words)
    rows = with_sets(docs, members, words)
    rows = rows.withColumns({"label": F.col("node"), "rest": F.lit(True)})
    found = across_shares(rows, SET_SHARE, t, True).distinct()
    sizes = sketched.groupBy("n", "s1", "s2").agg(F.count("*").alias("rows"))
    known = classes.drop("rows").join(sizes, ["n", "s1", "s2"]).select("node", "least", "rows")
    for end, side in (("u", "a"), ("v", "b")):
        own = known.select(F.col("node").alias(end), F.col("least").alias(f"id_{side}"), F.col("rows").alias(f"rows_{side}"))
        found = found.join(own, end)
    return found.select("id_a", "id_b", "rows_a", "rows_b")


def keep_one(docs: DataFrame, t: Fraction = THRESHOLD, words: int = WORDS) -> DataFrame:
    """docs with one row of each component: one with its least doc_id (null last), of these one with the least hash of its
    text, of equal ones one by a hash of the row.

    Rows whose sets are empty are linked with nothing and stay.
    """
    heads = first_rows(joined_rows(docs, t, words).filter("component IS NOT NULL"), "component")
    heads = heads.select("text_key", "rows").distinct()
    none = ~F.coalesce(F.col("text"), F.lit("")).rlike("[^\\x20\\x09-\\x0D]")
    named = heads.select(F.col("text_key").alias("_kindred_key"), F.col("rows").alias("_kindred_rows"))
    kept = docs.filter(~none).withColumn("_kindred_key", text_key()).join(named, "_kindred_key")
    single = kept.filter("_kindred_rows = 1").select(*docs.columns)
    repeated = common.one_of_each(kept.filter("_kindred_rows > 1"), "_kindred_key").select(*docs.columns)
    return docs.filter(none).union(single).union(repeated)
