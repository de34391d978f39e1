"""Operator 13: exact n-gram Jaccard join of whole documents by relations
between sets.

A document's set is its distinct four-word shingles (as 64-bit hashes, ASCII
letters lower-cased); two documents link when 100 * intersection >= 85 *
union. Documents with equal sets are one node. The order of shingles is the
same for all sets, rarest first: by how often their bucket of a counting
table of fixed size occurs in all documents, then by hash. Linked sets share a
shingle among the first |s| - ceil(0.85 |s|) + 1 of each (the prefix), so an
index list of each prefix shingle that two nodes have holds every link.

*Answers derived from a similar set's.* In the graph of shared lists each
node finds a leader: of the nodes that come first, in a random order, in its
lists, the one it meets most often, or that one's own; nodes of lists in which
another leader's group is the largest then go over to that one. Where the two are alike
(40 % or more), all that the node keeps is its difference from the leader, D:
shingles that one of the two lacks. The
links between the members of one leader follow from the differences alone,
with no set read again:

    |a ^ b| = |Da| + |Db| - 2 |Da & Db|,  a and b linked when
    185 (|a| + |b| - |a ^ b|) / 2 >= 85 (|a| + |b|)

so a group of thousands of near-copies costs one comparison with the leader
each, and products of small matrices. Groups are dealt in blocks of bounded
size; a pair of blocks whose sizes or sizes of D are too far apart is skipped
whole.

*Blocks of the index lists.* What is left are nodes of one list with
different leaders and in different components. Lists are cut into blocks by
size of the set and position of the shingle in it, hot ones by salt too; a
pair of blocks is skipped where the sizes, or the most that can be left
to share behind the positions, rule out each of its pairs. Pairs that pass the
same bounds one by one, in as many lists as sets of their sizes must share,
are compared exactly. Of each pair of blocks only the
links that join components are sent on. No list, group or component
is gathered in one task, and no pair of a group becomes a row unless it is
compared or linked.

Defined results: a text without words, null ones included, has an empty set,
0 shingles and its own doc_id as component. A text of one to three words has
one shingle, all its words. The component is the least doc_id reachable (null
only if all are). Every input row gives one row, repeated rows and ids
included; equal ids don't link by themselves. The counting table and the bounds
on blocks change cost only, never a result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .bit_table import BitTable
from .common import as_string_array, ready, slices, staged
from .graph import components
from .words import ascii_lowered, counted, shingles

WIDTH = 4
PERCENT = 85
#: Buckets of the counting table, 2**, and how many of them a row holds.
TABLE_BITS, RANGE = 20, 4096
#: Nodes, and shingles of their differences, a block holds on average.
BLOCK, BLOCK_SHINGLES = 256, 1 << 16
RELATED = 40
#: Members of a leader in one list that draw other nodes of the list to it.
CROWD = 4
LINKS = "a long, b long"
#: Bits of the table that says which texts are wanted, 2**.
KEY_BITS = 24


def prefix_length(size, percent: int = PERCENT):
    """How many shingles of a set are indexed."""
    return size - (percent * size + 99) // 100 + 1


def _sets(texts: pa.Array, width: int):
    doc, value, _ = counted(*shingles(ascii_lowered(texts), width))
    return doc, value, np.searchsorted(doc, np.arange(len(texts) + 1))


def _levels(own: DataFrame, width: int) -> np.ndarray:
    """For each bucket of hashes the binary logarithm of how often it occurs in
    the documents' sets. A task sends one table's counts at most; ranges of the
    table are added up apart, and its levels (1 MB) come to the driver."""
    ranges = (1 << TABLE_BITS) // RANGE

    def count(batches):
        table = np.zeros(1 << TABLE_BITS, np.int64)
        for b in slices(batches):
            value = _sets(as_string_array(b.column("text")), width)[1]
            table += np.bincount((value >> np.uint64(64 - TABLE_BITS)).astype(np.int64), minlength=len(table))
        rows = table.reshape(ranges, RANGE)
        some = np.flatnonzero(rows.any(1))
        for r in some:
            yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([rows[r].tobytes()], pa.binary())],
                                             names=["range", "counts"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for r, raw in zip(b.column("range").to_pylist(), b.column("counts"), strict=True):
                one = np.frombuffer(raw.as_buffer(), np.int64)
                sums[r] = sums[r] + one if r in sums else one
        for r, total in sums.items():
            level = np.frexp(total.astype(np.float64))[1].astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([level.tobytes()], pa.binary())],
                                             names=["range", "levels"])

    rows = (own.mapInArrow(count, "range int, counts binary").repartition("range")
            .mapInArrow(add, "range int, levels binary").collect())
    out = np.zeros((ranges, RANGE), np.uint8)
    for r in rows:
        out[r["range"]] = np.frombuffer(r["levels"], np.uint8)
    return out.reshape(-1)


def _signed(own: DataFrame, levels: np.ndarray, width: int, percent: int) -> DataFrame:
    """(doc_id, text_key, node, size, prefix); node and prefix are null for
    empty sets."""
    table = own.sparkSession.sparkContext.broadcast(levels)

    def sign(batches):
        for b in slices(batches):
            doc, value, at = _sets(as_string_array(b.column("text")), width)
            size = np.diff(at)
            bucket = (value >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
            order = np.lexsort((value, table.value[bucket], doc))
            place = np.arange(len(doc)) - at[doc]
            first = value[order][place < prefix_length(size, percent)[doc]].view(np.int64)
            ends = np.concatenate([[0], np.cumsum(np.where(size, prefix_length(size, percent), 0))]).astype(np.int32)
            none = pa.array(size == 0)
            raw = value.view(np.uint8)
            nodes = [hashlib.md5(raw[8 * i:8 * j]).digest() if j > i else None
                     for i, j in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text_key"), pa.array(nodes, pa.binary()), pa.array(size, pa.int32()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(first), mask=none)],
                names=["doc_id", "text_key", "node", "size", "prefix"])

    return own.mapInArrow(sign, "doc_id long, text_key binary, node binary, size int, prefix array<long>")


def _whole_sets(own: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(nid, set) for the (nid, text_key) of ``wanted``. The other texts stay
    where they are: a bit table of the keys passes few of them on."""
    table = BitTable(KEY_BITS).with_hashes(wanted.select(F.xxhash64("text_key").alias("h"))).share(own.sparkSession)

    def run(batches):
        keys = BitTable(*table.value)
        for b in slices(batches):
            b = b.filter(pa.array(keys.has(b.column("h").to_numpy().view(np.uint64))))
            if b.num_rows:
                _, value, at = _sets(as_string_array(b.column("text")), width)
                yield pa.RecordBatch.from_arrays(
                    [b.column("text_key"), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(value.view(np.int64)))],
                    names=["text_key", "set"])

    found = (own.select("text_key", "text", F.xxhash64("text_key").alias("h"))
             .mapInArrow(run, "text_key binary, set array<long>"))
    return found.groupBy("text_key").agg(F.first("set").alias("set")).join(wanted, "text_key").select("nid", "set")


def _row(column, i: int) -> np.ndarray:
    """A list cell as an array."""
    return column[i].values.to_numpy(zero_copy_only=False)


def _related(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(leader, nid, size, other) of the pairs (nid, leader) that are alike:
    the size of the node's set and how it differs from the leader's."""

    def run(batches):
        for b in batches:
            rows = []
            for i in range(b.num_rows):
                own, led = _row(b.column("set"), i), _row(b.column("led"), i)
                other = np.setxor1d(own, led, assume_unique=True)
                common = (len(own) + len(led) - len(other)) // 2
                if 100 * common >= percent * (len(other) + common):
                    rows.append((i, len(own), other))
            if rows:
                at, size, other = zip(*rows, strict=True)
                some = b.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [some.column("leader"), some.column("nid"), pa.array(size, pa.int32()),
                     pa.array(other, pa.list_(pa.int64()))], names=["leader", "nid", "size", "other"])

    led = sets.select(F.col("nid").alias("leader"), F.col("set").alias("led"))
    return (pairs.join(sets, "nid").join(led, "leader").select("nid", "leader", "set", "led")
            .mapInArrow(run, "leader long, nid long, size int, other array<long>"))


def _forest(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Which of the edges (a, b) join what the ones before don't."""
    root: dict[int, int] = {}

    def find(x):
        while root.get(x, x) != x:
            root[x] = x = root.get(root[x], root[x])
        return x
    out = []
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        x, y = find(x), find(y)
        if x != y:
            root[x] = y
            out.append(i)
    return out


def _common(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """How many values each of ``x`` shares with each of ``y``."""
    flat = np.concatenate([*x, *y]) if x and y else np.zeros(0, np.int64)
    out = np.zeros((len(x), len(y)), np.int64)
    if not len(flat):
        return out
    _, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(x) + len(y)), [len(s) for s in (*x, *y)])
    some = times > 1
    number = np.cumsum(some) - 1
    keep = some[column]
    row, column = row[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    wide = 2048
    for start in range(0, int(some.sum()), wide):      # small products, exact in float32
        i, j = np.searchsorted(column, [start, start + wide])
        m = np.zeros((len(x) + len(y), wide), np.float32)
        m[row[i:j], column[i:j] - start] = 1
        out += np.rint(m[:len(x)] @ m[len(x):].T).astype(np.int64)
    return out


def _members(cell):
    """(nodes, sizes, differences) of a block's list of structs."""
    s = cell.values
    node, size = (s.field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in ("nid", "size"))
    lists = s.field("other")
    flat, at = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    return node, size, [flat[at[i]:at[i + 1]] for i in range(len(node))]


def _group_links(related: DataFrame, percent: int) -> DataFrame:
    """(a, b): links between the members of each leader, of those of a pair of
    blocks as many as hold together what they hold together."""
    extent = F.size("other").alias("extent")
    whole = related.unionByName(related.groupBy("leader").agg(F.first("leader_size").alias("size"))
                                .select("leader", F.col("leader").alias("nid"), "size",
                                        F.array().cast("array<long>").alias("other"), F.col("size").alias("leader_size")))
    rows = whole.select("leader", "nid", "size", "other", extent,
                        F.floor(F.log2(F.size("other") + F.lit(1)) * 2).cast("int").alias("class"))
    salts = rows.groupBy("leader", "class").agg(
        (F.ceil(F.count("*") / BLOCK) + F.ceil(F.sum("extent") / BLOCK_SHINGLES)).alias("salts"))
    blocks = (rows.join(salts, ["leader", "class"])
              .withColumn("block", F.struct("class", F.pmod(F.xxhash64("nid"), F.col("salts")).alias("salt")))
              .groupBy("leader", "block")
              .agg(F.min("size").alias("least"), F.max("size").alias("most"), F.min("extent").alias("low"),
                   F.max("extent").alias("high"), F.collect_list(F.struct("nid", "size", "other")).alias("members")))
    blocks = staged(blocks, "group-blocks")
    x, y = (blocks.select("leader", *[F.col(c).alias(f"{c}_{n}") for c in blocks.columns[1:]]) for n in "xy")
    far = lambda p, q: (F.col(f"low_{p}") - F.col(f"high_{q}")) * (100 + percent)
    near = ((F.col("block_x") <= F.col("block_y"))
            & (F.col("most_x") * 100 >= F.col("least_y") * percent) & (F.col("most_y") * 100 >= F.col("least_x") * percent)
            & (F.greatest(far("x", "y"), far("y", "x")) <= (F.col("most_x") + F.col("most_y")) * (100 - percent)))

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                (na, sa, oa), (nb, sb, ob) = _members(b.column("members_x")[i]), _members(b.column("members_y")[i])
                la, lb = (np.array([len(o) for o in v], np.int64) for v in (oa, ob))
                apart = la[:, None] + lb[None, :] - 2 * _common(oa, ob)
                both = sa[:, None] + sb[None, :]
                p, q = np.nonzero((100 + percent) * (both - apart) >= 2 * percent * both)
                keep = _forest(na[p], nb[q])
                if keep:
                    yield pa.RecordBatch.from_arrays([pa.array(na[p][keep]), pa.array(nb[q][keep])], names=["a", "b"])

    return x.join(y, "leader").where(near).select("members_x", "members_y").mapInArrow(run, LINKS)


def _list_pairs(members: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """(a, b): nodes of common index lists in different components and with
    different leaders, which no bound rules out: sizes s <= t, linked from
    alpha = ceil(85 (s + t) / 185) common shingles on, have k of them in
    common among their first s - alpha + k and t - alpha + k, for any k. The
    prefixes are long enough for k = alpha - ceil(0.85 t) + 1.
    ``known``: (nid, leader, label)."""
    rows = (members.join(known, "nid", "left")
            .select("token", "nid", "size", "pos", F.coalesce("leader", "nid").alias("leader"),
                    F.coalesce("label", "nid").alias("label")))
    open_ = (rows.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high"),
                                       F.min("leader").alias("first"), F.max("leader").alias("last"),
                                       F.ceil(F.count("*") / BLOCK).alias("salts"))
             .where("low <> high AND first <> last").select("token", "salts"))
    rest = F.col("size") - F.col("pos")
    blocks = (rows.join(open_, "token")
              .withColumn("block", F.struct(F.floor(F.log2("size") * 4).cast("int").alias("s"),
                                            F.floor(F.log2(F.col("pos") + F.lit(1))).cast("int").alias("p"),
                                            F.pmod(F.xxhash64("nid"), F.col("salts")).alias("salt")))
              .groupBy("token", "block")
              .agg(F.min("size").alias("least"), F.max("size").alias("most"), F.max(rest).alias("rest"),
                   F.min("label").alias("low"), F.max("label").alias("high"),
                   F.collect_list(F.struct("nid", "size", "pos", "leader", "label")).alias("members")))
    blocks = staged(blocks, "list-blocks")
    x, y = (blocks.select("token", *[F.col(c).alias(f"{c}_{n}") for c in blocks.columns[1:]]) for n in "xy")
    near = ((F.col("block_x") <= F.col("block_y"))
            & (F.col("most_x") * 100 >= F.col("least_y") * percent) & (F.col("most_y") * 100 >= F.col("least_x") * percent)
            & (F.least("rest_x", "rest_y") * 100 >= F.greatest("least_x", "least_y") * percent)
            & ~((F.col("low_x") == F.col("high_x")) & (F.col("low_y") == F.col("high_y")) & (F.col("low_x") == F.col("low_y"))))

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                (n, s, r, g, c), (m, t, u, h, d) = (_entries(b.column(f"members_{k}")[i]) for k in "xy")
                large = np.maximum(s[:, None], t[None, :])
                ok = ((c[:, None] != d[None, :]) & (g[:, None] != h[None, :])
                      & (np.minimum(s[:, None], t[None, :]) * 100 >= large * percent)
                      & (np.minimum(r[:, None], u[None, :]) * 100 >= large * percent))
                if (b.column("block_x")[i].equals(b.column("block_y")[i])):
                    ok &= n[:, None] > m[None, :]        # a block with itself has each pair twice
                p, q = np.nonzero(ok)
                if len(p):
                    alpha = -(-percent * (s[p] + t[q]) // (100 + percent))
                    k = alpha + percent * large[p, q] // -100 + 1
                    yield pa.RecordBatch.from_arrays([pa.array(np.maximum(n[p], m[q])), pa.array(np.minimum(n[p], m[q])),
                                                      pa.array(k.astype(np.int32))], names=["a", "b", "k"])

    return (x.join(y, "token").where(near).select("block_x", "block_y", "members_x", "members_y")
            .mapInArrow(run, LINKS + ", k int").groupBy("a", "b").agg(F.count("*").alias("n"), F.max("k").alias("k"))
            .where("n >= k").select("a", "b"))


def _entries(cell):
    """(nodes, sizes, what is left from the position on, leaders, labels)."""
    s = cell.values
    node, size, pos, leader, label = (s.field(f).to_numpy(zero_copy_only=False).astype(np.int64)
                                      for f in ("nid", "size", "pos", "leader", "label"))
    return node, size, size - pos, leader, label


def _compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs of nodes whose sets link."""

    def run(batches):
        for b in batches:
            ok = np.zeros(b.num_rows, bool)
            for i in range(b.num_rows):
                x, y = _row(b.column("set_a"), i), _row(b.column("set_b"), i)
                common = len(np.intersect1d(x, y, assume_unique=True))
                ok[i] = 100 * common >= percent * (len(x) + len(y) - common)
            yield b.select(["a", "b"]).filter(pa.array(ok))

    side = lambda n: sets.select(F.col("nid").alias(n), F.col("set").alias(f"set_{n}"))
    return (pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "set_a", "set_b")
            .mapInArrow(run, LINKS))


def _leaders(members: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(nid, leader): for each node the one that comes first, in a random
    order, in most of its lists (an eighth of the prefix at least), or that
    one's own, where the sizes allow them to be alike."""
    first = members.groupBy("token").agg(F.min(F.struct(F.xxhash64("nid").alias("h"), "nid")).alias("hub"))
    shared = (members.join(first, "token").select("nid", "size", F.col("hub.nid").alias("hub")).where("nid <> hub")
              .groupBy("nid", "hub").agg(F.count("*").alias("n"), F.min("size").alias("size"))
              .where(F.col("n") * 8 >= prefix_length_of(F.col("size"))))
    near = staged(shared.groupBy("nid").agg(F.max(F.struct("n", "hub")).alias("best"))
                  .select("nid", F.col("best.hub").alias("near")), "near-leaders")
    step = near.select(F.col("nid").alias("of"), F.col("near").alias("far"))
    pairs = (near.join(step, F.col("near") == F.col("of"), "left")
             .select("nid", F.when(F.col("far") == F.col("nid"), F.col("near"))
                     .otherwise(F.coalesce("far", "near")).alias("leader")))
    return _sized(pairs, nodes, percent)


def _crowds(members: DataFrame, lead: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(nid, leader): for nodes of lists in which another leader's group is the
    largest, the leader they meet most of, if its groups there have
    ``CROWD`` members or more and their sizes allow them to be alike.
    ``lead``: (nid, leader) so far."""
    rows = (members.select("token", "nid").join(lead, "nid", "left")
            .select("token", "nid", F.coalesce("leader", "nid").alias("own")))
    crowd = (rows.groupBy("token", "own").agg(F.count("*").alias("n")).groupBy("token")
             .agg(F.max(F.struct("n", "own")).alias("most")).where(F.col("most.n") >= CROWD)
             .select("token", F.col("most.own").alias("leader"), F.col("most.n").alias("n")))
    met = (rows.join(crowd, "token").where("own <> leader AND nid <> leader").groupBy("nid", "leader").agg(F.sum("n").alias("n"))
           .groupBy("nid").agg(F.max(F.struct("n", "leader")).alias("most")).select("nid", F.col("most.leader").alias("leader")))
    return _sized(met, nodes, percent)


def _sized(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(nid, leader, leader_size) of pairs whose sizes allow them to be alike."""
    own, led = (nodes.select(F.col("nid").alias(n), F.col("size").alias(f"{n}_size")) for n in ("nid", "leader"))
    return (pairs.join(own, "nid").join(led, "leader")
            .where(F.least("nid_size", "leader_size") * 100 >= F.greatest("nid_size", "leader_size") * percent)
            .select("nid", "leader", "leader_size"))


def prefix_length_of(size, percent: int = PERCENT):
    """:func:`prefix_length` of a column."""
    return size - F.ceil(size * percent / 100) + 1


def joined(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
           width: int = WIDTH) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of ``docs``."""
    ready(docs.sparkSession)
    own = docs.select(docs[id_col].cast("long").alias("doc_id"),
                      F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    own = own.withColumn("text_key", F.unhex(F.md5(F.col("text").cast("binary"))))
    rows = staged(_signed(own, _levels(own, width), width, percent), "sets")
    nodes = staged(rows.where("node IS NOT NULL").groupBy("node")
                   .agg(F.min("doc_id").alias("least"), F.min("text_key").alias("text_key"),
                        F.first("size").alias("size"), F.first("prefix").alias("prefix"))
                   .withColumn("nid", F.monotonically_increasing_id()), "nodes")      # a short name, fixed once written
    postings = nodes.select("nid", "size", F.posexplode("prefix").alias("pos", "token"))
    shared = postings.groupBy("token").agg(F.count("*").alias("n")).where("n > 1").select("token")
    members = staged(postings.join(shared, "token").select("token", "nid", "size", "pos"), "members")

    def sets_of(some):
        """The sets of the nodes in the columns of frames."""
        return staged(_whole_sets(own, some.distinct().join(nodes.select("nid", "text_key"), "nid"), width), "whole-sets")

    both = lambda frame, a, b: frame.select(F.explode(F.array(a, b)).alias("nid"))
    def related_to(leaders):
        leaders = staged(leaders, "leaders")
        found = _related(leaders.select("nid", "leader"), sets_of(both(leaders, "nid", "leader")), RELATED)
        return staged(found.join(leaders.select("nid", "leader_size"), "nid"), "related")

    related = related_to(_leaders(members, nodes, RELATED))
    moved = related_to(_crowds(members, related.select("nid", "leader").unionByName(
        related.select(F.col("leader").alias("nid"), "leader").distinct().join(related.select("nid"), "nid", "left_anti")),
        nodes, RELATED))
    related = moved.unionByName(related.join(moved.select("nid"), "nid", "left_anti"))
    links = staged(_group_links(related, percent), "group-links")
    label = staged(components(links), "classes").select(F.col("node").alias("of"), F.col("root").alias("label"))
    lead = related.select("nid", "leader").unionByName(
        related.select(F.col("leader").alias("nid"), "leader").distinct().join(related.select("nid"), "nid", "left_anti"))
    known = staged(lead.join(label, F.col("nid") == F.col("of"), "left").select("nid", "leader", "label"), "known")
    pairs = staged(_list_pairs(members, known, percent), "list-pairs")
    links = links.unionByName(_compared(pairs, sets_of(both(pairs, "a", "b")), percent))
    of = components(links)

    by_node = (nodes.select("node", "nid", "least").join(of.withColumnRenamed("node", "of"), F.col("nid") == F.col("of"), "left")
               .select("node", "least", F.coalesce("root", "nid").alias("root")))
    least = by_node.groupBy("root").agg(F.min("least").alias("component_id"))
    by_node = staged(by_node.join(least, "root").select("node", "component_id"), "components")
    return (rows.select("doc_id", "node", "size").join(by_node, "node", "left")
            .select("doc_id", F.col("size").cast("long").alias("n_shingles"),
                    F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))
