r"""MinHash near-dedup with HyperMinHash registers.

1. Tasks turn each text into the set of its distinct word shingles and
   compress it to 128 registers: 8 tables of 16 buckets, each bucket keeping
   its smallest hash as leading-zero count (6 bits) plus mantissa (10 bits).
   Equal sets (128-bit set key and size) become one node at once, named by
   their smallest doc_id, so exact copies cost no candidate at all.
2. Four neighbouring registers make a 64-bit band key.  At similarity 0.8 two
   sets share a given band with probability 0.41 and none of the 32 with
   5e-8.  In a bucket (band, key) the node with the largest buckets, as a rule
   the text that the others were made from, is the hub; every node joins its
   largest hub's group.
3. A group is compared in blocks of bounded size: first every node with the
   hub, then only the nodes that the hub does not link with all others, on the
   full sets, by one matrix product per block over the shingles that at least
   two of its nodes hold.  A block returns its nodes' components, never its
   pairs.
4. Buckets that still hold several components of different groups are
   compared likewise, in blocks, each pair in the first band that it shares.
   Here the collision-corrected estimate goes first: pairs that show fewer
   equal registers than a pair at 0.8 does but once in 1e9 (Chernoff's bound,
   a fiftieth of what the bands lose) are not verified on the full sets.

Defined results: a null or empty text has no shingle and no link; a text
shorter than a shingle is one shingle; repeated rows share component and
verdict; a row without doc_id is linked with nothing and kept; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components, stored
from .tokens import let_go
from .words import Words, chunks, combine, mix, ngram_keys, split_words

TABLES, BUCKETS, BAND = 8, 16, 4
REGISTERS = TABLES * BUCKETS
MANTISSA = 10
EMPTY = np.uint16(0xFFFF)
SIMILARITY_PERCENT = 80
#: Rows of a bucket or group, and their shingles, in one part of a block.
BLOCK_ROWS = 2048
BLOCK_SHINGLES = 2_000_000
#: Probability at which the estimate may rule out a pair at the threshold.
MISSED = 1e-9
_SEEDS = mix(np.arange(1, TABLES + 1, dtype=np.uint64))

FEATURES = "doc_id long, n_shingles long, k1 long, k2 long, sig binary"


def shingle_sets(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, key) of every text's distinct n-word shingles, ordered by text.
    A text of fewer words has its whole sequence as one shingle."""
    text_of, counts = words.text_of, words.counts
    grams = ngram_keys(words.key, n)
    inside = text_of[: len(grams)] == text_of[n - 1:] if len(grams) else np.zeros(0, bool)
    who, key = text_of[: len(grams)][inside], grams[inside]
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        whole = []
        with np.errstate(over="ignore"):
            for i in short:
                k = words.key[words.first[i]:words.first[i + 1]]
                x = k[:1]
                for j in range(1, len(k)):
                    x = combine(x, k[j:j + 1])
                whole.append(mix(x + np.uint64(len(k)))[0])
        who = np.concatenate([who, short])
        key = np.concatenate([key, np.array(whole, np.uint64)])
    order = np.lexsort((key, who))
    who, key = who[order], key[order]
    new = np.ones(len(who), bool)
    new[1:] = (who[1:] != who[:-1]) | (key[1:] != key[:-1])
    return who[new], key[new]


def registers(who: np.ndarray, key: np.ndarray, n_texts: int) -> np.ndarray:
    """HyperMinHash registers, (n_texts, 128) uint16."""
    out = np.empty((n_texts, REGISTERS), np.uint16)
    none = np.uint64(2**53)
    with np.errstate(over="ignore"):
        for t in range(TABLES):
            x = mix(key ^ _SEEDS[t])
            low = np.full(n_texts * BUCKETS, none, np.uint64)
            np.minimum.at(low, who * BUCKETS + (x & np.uint64(BUCKETS - 1)).astype(np.int64), x >> np.uint64(11))
            bits = np.frexp(low.astype(np.float64))[1]  # 0 to 53: exact, as low has at most 53 bits
            lead = np.clip(53 - bits, 0, 53)
            frac = ((low << (lead + 1).astype(np.uint64)) & (none - np.uint64(1))) >> np.uint64(53 - MANTISSA)
            reg = (lead.astype(np.uint64) << np.uint64(MANTISSA) | frac).astype(np.uint16)
            reg[low == none] = EMPTY
            out[:, t * BUCKETS:(t + 1) * BUCKETS] = reg.reshape(n_texts, BUCKETS)
    return out


def features(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, n_shingles, k1, k2, sig) of every row."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for part in chunks(batch):
                w = split_words(part.column(1), lower=True)
                who, key = shingle_sets(w, n)
                sizes = np.bincount(who, minlength=part.num_rows)
                ends = np.concatenate([[0], np.cumsum(sizes)])
                keys = []
                with np.errstate(over="ignore"):
                    for h in (mix(key), mix(key ^ _SEEDS[0])):
                        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h, dtype=np.uint64)])
                        keys.append((sums[ends[1:]] - sums[ends[:-1]]).view(np.int64))
                sig = registers(who, key, part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(keys[0]),
                     pa.array(keys[1]), pa.array([r.tobytes() for r in sig], pa.binary())],
                    ["doc_id", "n_shingles", "k1", "k2", "sig"])

    return docs.select("doc_id", "text").mapInArrow(compute, FEATURES)


def band_rows(sets: DataFrame) -> DataFrame:
    """(band, key, node) of every set's bands with a filled register."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = signatures(batch.column(1).to_pylist())
            keys = band_keys(sig)
            full = keys != -1
            node = np.repeat(batch.column(0).to_numpy(zero_copy_only=False)[:, None], keys.shape[1], 1)
            band = np.broadcast_to(np.arange(keys.shape[1], dtype=np.int32), keys.shape)
            yield pa.RecordBatch.from_arrays(
                [pa.array(band[full]), pa.array(keys[full]), pa.array(node[full])], ["band", "key", "node"])

    return sets.select("node", "sig").mapInArrow(compute, "band int, key long, node long")


def signatures(rows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(rows), np.uint16).reshape(-1, REGISTERS)


def band_keys(sig: np.ndarray) -> np.ndarray:
    """The bands' keys, (rows, bands); -1: no register of the band is filled."""
    return np.ascontiguousarray(sig).view(np.int64).reshape(len(sig), REGISTERS // BAND)


def first_band(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The first band that the rows of a and b share (0 if none)."""
    x = band_keys(a)
    return ((x == band_keys(b)) & (x != -1)).argmax(1)


@functools.cache
def fewest_equal(percent: int) -> np.ndarray:
    """By number of filled registers: the fewest equal ones that a pair at
    ``percent`` may show.  Fewer has a probability under MISSED by Chernoff's
    bound, exp(-n KL(x / n || percent))."""
    p, out = percent / 100, np.zeros(REGISTERS + 1, np.int64)
    for n in range(1, REGISTERS + 1):
        x = np.arange(n + 1) / n
        with np.errstate(divide="ignore", invalid="ignore"):
            kl = (np.where(x > 0, x * np.log(x / p), 0)
                  + (np.where(x < 1, (1 - x) * np.log((1 - x) / (1 - p)), 0) if p < 1 else np.where(x < 1, np.inf, 0)))
        out[n] = np.argmax((n * kl <= -np.log(MISSED)) | (x >= p))
    return out


def may_match(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, percent: int) -> tuple:
    """(collision-corrected estimate, whether similarity ``percent`` is still
    possible) of rows of registers; a and b broadcast against each other on
    the leading axes."""
    filled = ((a != EMPTY) | (b != EMPTY)).sum(-1)
    same = ((a == b) & (a != EMPTY)).sum(-1)
    ratio = np.minimum(na, nb) / np.maximum(na, nb)
    chance = 0.169919487159739 * 2.0**-MANTISSA * 4 * ratio / (1 + ratio) ** 2
    estimate = (same / np.maximum(filled, 1) - chance) / (1 - chance)
    # (chance collisions only raise ``same``); the sizes bound the similarity exactly
    return estimate, (same >= fewest_equal(percent)[filled]) & (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb))


def full_sets(docs: DataFrame, nodes: DataFrame, n: int) -> DataFrame:
    """(node, n, sig, keys): the nodes' whole shingle sets, sorted."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for part in chunks(batch):
                who, key = shingle_sets(split_words(part.column(1), lower=True), n)
                cut = np.concatenate([[0], np.cumsum(np.bincount(who, minlength=part.num_rows))])
                keys = [key[x:y].tobytes() for x, y in zip(cut[:-1].tolist(), cut[1:].tolist())]
                yield pa.RecordBatch.from_arrays([*part.columns[:1], *part.columns[2:], pa.array(keys, pa.binary())],
                                                 ["node", "n", "sig", "keys"])

    rows = docs.select(F.col("doc_id").alias("node"), "text").join(nodes, "node")
    return rows.select("node", "text", "n", "sig").mapInArrow(compute, "node long, n long, sig binary, keys binary")


def shared_counts(keys: list[np.ndarray], some: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets ``some`` with all sets: a
    matrix product over the keys that two sets or more hold."""
    row = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
    _, column, held = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    common = held > 1
    rank = np.cumsum(common) - 1
    ok = common[column]
    row, column = row[ok], rank[column[ok]]
    out = np.zeros((len(some), len(keys)), np.float32)
    width = int(common.sum())
    for at in range(0, width, 1024):
        here = (column >= at) & (column < at + 1024)
        x = np.zeros((len(keys), min(1024, width - at)), np.float32)
        x[row[here], column[here] - at] = 1
        out += x[some] @ x.T
    return out


class Union:
    """Components of a few local nodes."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, x: int, y: int):
        self.up[self.find(x)] = self.find(y)


def block_links(node: np.ndarray, n: np.ndarray, keys: list[np.ndarray], hub: int, percent: int) -> list[tuple[int, int]]:
    """(node, smallest node of its component) for the linked nodes of one
    block.  ``hub``: the hub's row."""
    components_ = Union(len(node))

    def compare(rows: np.ndarray):
        for at in range(0, len(rows), 512):
            some = rows[at:at + 512]
            shared = shared_counts(keys, some)
            ok = 100 * shared >= percent * (n[some][:, None] + n[None] - shared)
            for r, x in enumerate(some.tolist()):
                other = np.flatnonzero(ok[r])
                other = other[node[other] != node[x]]
                for y in other.tolist():
                    components_.join(x, y)

    compare(np.array([hub]))
    main = components_.find(hub)
    alone = np.array([x for x in range(len(node)) if components_.find(x) != main], np.int64)
    compare(alone)
    low: dict[int, int] = {}
    for x, i in enumerate(node.tolist()):
        r = components_.find(x)
        low[r] = min(low.get(r, i), i)
    return sorted({(i, low[components_.find(x)]) for x, i in enumerate(node.tolist()) if i != low[components_.find(x)]})


def _parts(width: str) -> Column:
    """Into how many parts rows of this width are dealt."""
    return F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS),
                      F.ceil(F.sum(width) / BLOCK_SHINGLES)).cast("int").alias("parts")


def group_links(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): nodes and the smallest nodes of their components, by block of
    every group.  groups: (hub,
    node), the hub among its nodes; sets: full_sets()."""
    size = groups.join(sets.select("node", "n"), "node").groupBy("hub").agg(_parts("n"))
    m = groups.join(size, "hub")
    m = m.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    # block pair (i, j), i <= j: a row of part p goes to (p, j) and (i, p), the hub to all
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    own = F.transform(every, lambda o: F.struct(F.least("part", o).alias("i"), F.greatest("part", o).alias("j")))
    all_ = F.flatten(F.transform(every, lambda i: F.transform(F.sequence(i, F.col("parts") - 1),
                                                              lambda j: F.struct(i.alias("i"), j.alias("j")))))
    m = m.withColumn("o", F.explode(F.when(F.col("node") == F.col("hub"), all_).otherwise(own)))
    m = m.select("hub", "o.i", "o.j", "node").join(sets, "node").select("hub", "i", "j", "node", "n", "keys")

    def links_of(rows: pa.Table) -> list[tuple[int, int]]:
        hub, node = rows.column("hub")[0].as_py(), rows.column("node").to_numpy()
        at = np.flatnonzero(node == hub)
        if not len(at) or len(node) < 2:
            return []
        keys = [np.frombuffer(k, np.uint64) for k in rows.column("keys").to_pylist()]
        return block_links(node, rows.column("n").to_numpy(), keys, int(at[0]), percent)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks_of(batches, ["hub", "i", "j"]):
            for a, b in bounds_of(block, ["hub", "i", "j"]):
                found = links_of(block.slice(a, b - a))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], ["a", "b"])

    block = ["hub", "i", "j"]
    return m.repartition(*block).sortWithinPartitions(*block).mapInArrow(search, "a long, b long").distinct()


def bounds_of(rows: pa.Table, by: list[str]) -> list[tuple[int, int]]:
    """[begin, end) of the runs of equal ``by``."""
    new = np.ones(rows.num_rows, bool)
    columns = [rows.column(f).to_numpy() for f in by]
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    at = np.flatnonzero(new).tolist()
    return list(zip(at, [*at[1:], rows.num_rows]))


def blocks_of(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.Table]:
    """Tables of whole runs of equal ``by`` from rows sorted by it; a run may
    go on in the next batch."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        last = bounds_of(rows, by)[-1][0]
        held = rows.slice(last)
        if last:
            yield rows.slice(0, last).combine_chunks()
    if held is not None:
        yield held.combine_chunks()


def cross_pairs(group: np.ndarray, part: np.ndarray, i: np.ndarray, j: np.ndarray, comp: np.ndarray,
                hub: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs (r < c) of one block that lie in parts (i, j), in two
    components and in two hubs' groups, some ten thousand at a time.  Rows are
    ordered by block (``group``)."""
    end = np.searchsorted(group, group, side="right")
    partners = end - np.arange(len(group)) - 1
    total = np.concatenate([[0], np.cumsum(partners)])
    row = 0
    while row < len(group):
        stop = max(row + 1, int(np.searchsorted(total, total[row] + 1_000_000, side="right")) - 1)
        n = partners[row:stop]
        r = np.repeat(np.arange(row, stop), n)
        c = r + 1 + np.arange(len(r)) - np.repeat(total[row:stop] - total[row], n)
        ok = (comp[r] != comp[c]) & (hub[r] != hub[c]) & (np.minimum(part[r], part[c]) == i[r]) & (np.maximum(part[r], part[c]) == j[r])
        r, c = r[ok], c[ok]
        for at in range(0, len(r), 50_000):
            yield r[at:at + 50_000], c[at:at + 50_000]
        row = stop


def open_links(members: DataFrame, groups: DataFrame, comps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links of nodes that share a bucket but neither component nor
    group.  sets: full_sets()."""
    of_node = (groups.join(comps.select(F.col("a").alias("node"), F.col("b").alias("comp")), "node", "left")
               .join(sets.select("node", F.col("n").alias("width")), "node"))
    m = members.join(of_node.withColumn("comp", F.coalesce("comp", "node")), "node")
    mixed = (m.groupBy("band", "key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("hub").alias("h1"),
                                          F.max("hub").alias("h2"), _parts("width"))
             .where("lo < hi and h1 < h2").select("band", "key", "parts"))
    m = m.join(mixed, ["band", "key"])
    m = m.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    # block pair (i, j), i <= j: a row of part p goes to (p, j) and (i, p)
    m = m.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    m = m.select("band", "key", "node", "comp", "hub", "part", F.least("part", "o").alias("i"),
                 F.greatest("part", "o").alias("j"))
    m = m.join(sets, "node")
    block = ["band", "key", "i", "j"]
    m = m.repartition(*block).sortWithinPartitions(*block)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in blocks_of(batches, block):
            c = {f: rows.column(f).to_numpy() for f in (*block, "node", "comp", "hub", "part", "n")}
            sig = signatures(rows.column("sig").to_pylist())
            keys = [np.frombuffer(k, np.uint64) for k in rows.column("keys").to_pylist()]
            run = np.repeat(np.arange(len(at := bounds_of(rows, block))), [y - x for x, y in at])
            for x, y in cross_pairs(run, c["part"], c["i"], c["j"], c["comp"], c["hub"]):
                ok = may_match(sig[x], sig[y], c["n"][x], c["n"][y], percent)[1]
                x, y = x[ok], y[ok]
                # a pair counts in the first of the bands that it shares
                first = first_band(sig[x], sig[y]) == c["band"][x]
                found = []
                for r, q in zip(x[first].tolist(), y[first].tolist()):
                    shared = len(np.intersect1d(keys[r], keys[q], assume_unique=True))
                    if 100 * shared >= percent * (len(keys[r]) + len(keys[q]) - shared):
                        found.append((int(c["node"][r]), int(c["node"][q])))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(f, pa.int64()) for f in zip(*found)], ["a", "b"])

    return m.mapInArrow(search, "a long, b long").distinct()


def hub_groups(members: DataFrame) -> DataFrame:
    """(hub, node): each node's hub.  members: (band, key, node, size)."""
    weight = members.groupBy("node").agg(F.sum("size").alias("weight"))
    hubs = members.join(weight, "node").groupBy("band", "key").agg(
        F.max(F.struct("weight", (-F.col("node")).alias("minus"))).alias("hub"))
    return members.join(hubs, ["band", "key"]).groupBy("node").agg(F.max("hub").alias("hub")).select(
        (-F.col("hub.minus")).alias("hub"), "node")


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = SIMILARITY_PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row."""
    feats = stored(features(docs, n), "features")
    ids = feats.where("doc_id is not null and n_shingles > 0")
    sets = stored(ids.groupBy("k1", "k2", "n_shingles").agg(
        F.min("doc_id").alias("node"), F.first("sig").alias("sig")).withColumnRenamed("n_shingles", "n"), "sets")

    bands = band_rows(sets)
    shared = bands.groupBy("band", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = stored(bands.join(shared, ["band", "key"]), "buckets")
    groups = stored(hub_groups(members), "groups")
    members = members.drop("size")
    full = stored(full_sets(docs, sets.join(groups.select("node").distinct(), "node", "left_semi"), n), "sets-full")

    links = stored(group_links(groups.unionByName(groups.select("hub", F.col("hub").alias("node"))).distinct(),
                               full, percent), "links")
    comps = components(links)
    more = stored(open_links(members, groups, comps, full, percent), "links")
    if not more.isEmpty():
        comps = components(comps.unionByName(more))

    named = sets.select("k1", "k2", F.col("n").alias("n_shingles"), "node").join(
        comps.select(F.col("a").alias("node"), F.col("b").alias("low")), "node", "left").select(
        "k1", "k2", "n_shingles", F.coalesce("low", "node").alias("low"))
    out = feats.drop("sig").join(named, ["k1", "k2", "n_shingles"], "left")
    component = F.when(F.col("doc_id").isNull() | (F.col("n_shingles") == 0), F.col("doc_id")).otherwise(F.col("low"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op9_minhash_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document's component over its 2-word shingles."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), n=2)


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each group of near copies stays, also
    of rows that repeat a doc_id with its text and of rows without doc_id
    (which stay only if no linked row has a doc_id)."""
    known = docs.where("doc_id is not null")
    top = known.agg(F.max("doc_id")).first()[0] or 0
    # rows without doc_id take part under numbers above all others
    rest = stored(docs.where("doc_id is null").withColumn("doc_id", F.lit(top + 1) + F.monotonically_increasing_id()), "no-id")
    numbered = known.unionByName(rest.select(*docs.columns))
    gone = near_duplicates(numbered).where(~F.col("kept")).select("doc_id").distinct()
    kept = numbered.join(gone, "doc_id", "left_anti").select(*docs.columns)
    repeated = stored(docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    if not repeated.isEmpty():
        kept = kept.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(
            kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]).select(*docs.columns))
    shown = F.when(F.col("doc_id") <= top, F.col("doc_id")).cast(docs.schema["doc_id"].dataType).alias("doc_id")
    return kept.select(*(shown if c == "doc_id" else F.col(c) for c in docs.columns))
