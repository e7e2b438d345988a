"""Conversation prefix trie: ternary search trees over ranges of turn sequences, merged at their edges.

Turns become ids of a dictionary of distinct (role, text), so a conversation is one row of 8-byte ids
and no text is gathered. Conversations with the same sequence are counted before the sequences are
dealt by range. Each range shard builds a ternary search tree by inserting medians first and walks it
without recursion. A node whose members may reach into the next shard is a prefix of the shard's first
or last sequence: only these paths leave the task, and runs of neighbouring shards merge them until
one run is left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fxtape.shared import published

WORDS = r"[^\x20\x09-\x0D]+"
CHUNK_BITS = 10  # members that are written as one text lie in a range of 1,024 ids
SHARD_TURNS = 200_000  # of a tree; a range with more of them is built as several trees
RUN = 64  # neighbouring shards merged by one task

NODE = (
    "shard long, pos long, open boolean, key binary, parent_key binary, conv_id long, depth long, "
    "parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string, words long"
)
FIELDS = [part.split()[0] for part in NODE.split(", ")]
_ARROW = {"long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string()}
ARROW = pa.schema([(name, _ARROW[kind]) for name, kind in (part.split() for part in NODE.split(", "))])
NO_MEMBERS = hashlib.sha256(b"").hexdigest()


def encoded(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, turns) with one row per conversation: its turns in order as (id, words) structs.

    Equal (role, text) pairs get one id. A null role or text is the empty one; a null turn comes first,
    and turns at one place are ordered by their digest, so equal rows may come in any order. Rows without
    a conversation id are left out. Other columns are not read. A conversation is one row of 16 bytes
    a turn.
    """
    who, what = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    turns = published(
        conversations.where(F.col(conv).isNotNull()).select(
            F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("place"),
            F.sha2(F.concat(F.length(who).cast("string"), F.lit(":"), who, what), 256).alias("digest"),
            F.regexp_count(what, F.lit(WORDS)).cast("long").alias("words"),
        ),
        "turns",
    )
    known = turns.groupBy("digest").agg(F.any_value("words").alias("words"))
    known = published(known.withColumn("id", F.monotonically_increasing_id()), "turn_ids")
    coded = turns.drop("words").join(known, "digest")
    row = F.struct("place", "digest", F.struct("id", "words").alias("turn"))
    return coded.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).getField("turn").alias("turns"))


class TernaryTree:
    """Sequences of ids, each tree node one trie node; node 0 is the empty sequence."""

    def __init__(self, sequences: list[tuple]):
        """``sequences``: distinct (ids, words, members, smallest member, digest of members), sorted."""
        self.split, self.low, self.high, self.child = [0], [0], [0], [0]
        self.words, self.own = [0], [None]
        waiting = [(0, len(sequences))]
        while waiting:
            begin, end = waiting.pop()
            if begin < end:
                median = (begin + end) // 2
                self.insert(*sequences[median])
                waiting += [(median + 1, end), (begin, median)]

    def insert(self, ids: list[int], words: list[int], *members) -> None:
        at = 0
        for turn, n in zip(ids, words, strict=True):
            side, holder = self.child, at
            while (node := side[holder]) and self.split[node] != turn:
                side, holder = self.low if turn < self.split[node] else self.high, node
            if not node:
                node = side[holder] = len(self.split)
                self.split.append(turn)
                for links in (self.low, self.high, self.child):
                    links.append(0)
                self.words.append(n)
                self.own.append(None)
            at = node
        self.own[at] = members

    def path(self, ids: list[int]) -> list[int]:
        """The node of each turn of a sequence that is in the tree."""
        found, at = [], 0
        for turn in ids:
            at = self.child[at]
            while self.split[at] != turn:
                at = self.low[at] if turn < self.split[at] else self.high[at]
            found.append(at)
        return found

    def preorder(self) -> Iterator[tuple[int, int, int]]:
        """(node, depth, position of the parent) in the order of the sequences, without recursion."""
        yield 0, 0, -1
        position = 1
        waiting = [(self.child[0], 1, 0, False)]
        while waiting:
            node, depth, parent, below_done = waiting.pop()
            if not node:
                continue
            if below_done:
                yield node, depth, parent
                waiting.append((self.child[node], depth + 1, position, False))
                position += 1
            else:
                waiting += [
                    (self.high[node], depth, parent, False), (node, depth, parent, True),
                    (self.low[node], depth, parent, False),
                ]


@dataclass
class Node:
    """A trie node with what is known of its subtree; open while its neighbours may add to it."""

    depth: int
    words: int
    parent: int
    key: bytes | None = None
    n_convs: int = 0
    conv_id: int | None = None
    n_children: int = 0
    n_leaves: int = 0
    saved: int = 0
    ends: str | None = None
    open: bool = False

    def add(self, n_convs: int, conv_id: int | None, children: int, leaves: int, saved: int) -> None:
        self.n_convs += n_convs
        if conv_id is not None and (self.conv_id is None or conv_id < self.conv_id):
            self.conv_id = conv_id
        self.n_children += children
        self.n_leaves += leaves
        self.saved += saved


def closed(nodes: list[Node]) -> None:
    """Complete every node that is not open and add it to its parent, which stands before it."""
    for node in reversed(nodes):
        if not node.open:
            node.n_leaves = node.n_leaves or 1
            node.saved += (node.n_convs - 1) * node.words
            if node.parent >= 0:
                nodes[node.parent].add(node.n_convs, node.conv_id, 1, node.n_leaves, node.saved)


def rows(nodes: list[Node], shard: int = 0) -> pa.RecordBatch:
    """Complete nodes with what they know of their parent; open ones with their place in the shard."""
    columns: dict[str, list] = {name: [] for name in FIELDS}
    for pos, node in enumerate(nodes):
        parent = None if node.open or node.parent < 0 else nodes[node.parent]
        waits = parent is not None and parent.open
        values = (
            shard, pos, node.open, node.key, parent.key if waits else None, node.conv_id, node.depth,
            parent.conv_id if parent is not None and not waits else None, node.n_convs, node.n_children,
            node.n_leaves, node.saved, node.ends, node.words,
        )
        for name, value in zip(FIELDS, values, strict=True):
            columns[name].append(value)
    return pa.RecordBatch.from_pydict(columns, ARROW)


def shard_nodes(sequences: list[tuple]) -> list[Node]:
    """All nodes of a shard in order; those on the paths of its first and last sequence stay open.

    An open node's key is the digest chain of its turn ids, the same in every shard.
    """
    tree, nodes, keys = TernaryTree(sequences), [], {0: b""}
    for ids in (sequences[0][0], sequences[-1][0]):
        key = b""
        for at, turn in zip(tree.path(ids), ids, strict=True):
            key = keys[at] = hashlib.sha256(key + turn.to_bytes(8, "little")).digest()
    for at, depth, parent in tree.preorder():
        node = Node(depth, tree.words[at], parent, keys.get(at), open=at in keys)
        if tree.own[at]:
            n, smallest, node.ends = tree.own[at]
            node.add(n, smallest, 0, 0, 0)
        nodes.append(node)
    closed(nodes)
    return nodes


def merged(paths: list[Node], whole: bool) -> list[Node]:
    """Nodes of neighbouring shards' open paths, equal ones added up and inner ones closed.

    ``paths`` holds the shards in order, each with its open nodes in order. The first path and the last
    one stay open unless the run is ``whole``.
    """
    nodes: list[Node] = []
    here: list[int] = []
    for part in paths:
        d = part.depth
        if d < len(here) and nodes[here[d]].key == part.key:
            same = nodes[here[d]]
            same.add(part.n_convs, part.conv_id, part.n_children, part.n_leaves, part.saved)
            same.ends = same.ends or part.ends
            continue
        del here[d:]
        nodes.append(
            Node(d, part.words, here[-1] if here else -1, part.key, part.n_convs, part.conv_id,
                 part.n_children, part.n_leaves, part.saved, part.ends)
        )
        here.append(len(nodes) - 1)
    if not whole:
        for at in here:
            nodes[at].open = True
        for i, node in enumerate(nodes):
            if node.depth != i:
                break
            node.open = True
    closed(nodes)
    return nodes


def sharded(chunks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of one range, from (ids, words, members) sorted by ids and by members inside them."""
    shard = TaskContext.get().partitionId()
    held: list[tuple] = []
    turns, edge = 0, []
    last, total, smallest, digest = None, 0, None, None

    def built() -> pa.RecordBatch:
        nonlocal edge
        nodes = shard_nodes(held)
        if edge:
            joined = merged(edge + [n for n in nodes if n.open], False)
            edge = [n for n in joined if n.open]
            return pa.concat_batches([complete(rows(nodes)), complete(rows(joined))])
        edge = [n for n in nodes if n.open]
        return complete(rows(nodes))

    for batch in chunks:
        for ids, words, n, first, text in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if last is not None and ids == last[0]:
                total += n
                digest.update(b"," + text.encode())
                continue
            if last is not None:
                held.append((*last, total, smallest, digest.hexdigest()))
                turns += len(last[0]) + 1
                if turns >= SHARD_TURNS:
                    yield built()
                    held, turns = [], 0
            last, total, smallest, digest = (ids, words), n, first, hashlib.sha256(text.encode())
    if last is not None:
        held.append((*last, total, smallest, digest.hexdigest()))
        yield built()
        yield rows(edge, shard)


def complete(batch: pa.RecordBatch) -> pa.RecordBatch:
    return batch.filter(pc.invert(batch.column("open")))


def stored_nodes(table: pa.Table) -> list[Node]:
    """Open nodes as they were written, in the order of their shards."""
    return [
        Node(r["depth"], r["words"], -1, r["key"], r["n_convs"], r["conv_id"], r["n_children"], r["n_leaves"],
             r["saved_tokens"], r["ends_sha256"])
        for r in table.sort_by([("shard", "ascending"), ("pos", "ascending")]).to_pylist()
    ]


def of_run(whole: bool):
    """Merges the open paths of a run of shards into one shard."""

    def run(part: pa.Table) -> pa.Table:
        nodes = merged(stored_nodes(part), whole)
        return pa.Table.from_batches([rows(nodes, part.column("shard")[0].as_py() // RUN)])

    return run


def tried(sequences: DataFrame, shards: int | None = None) -> DataFrame:
    """Every node of the prefix trie over (conv_id, turns), as ``encoded`` gives them.

    Per node: conv_id, its smallest member; depth; parent_conv_id, its parent's smallest member (null at
    the root); n_convs, members; n_children; n_leaves, childless nodes in its subtree; saved_tokens, over
    its subtree, (n_convs - 1) times the words of a node's last turn; ends_sha256, the digest of the ids
    of members that end here, ascending and joined by commas. A null ``turns`` is a sequence without
    turns. Conversation ids are distinct; no conversations give no nodes.
    """
    spark = sequences.sparkSession
    of_turn = "array<struct<id:bigint,words:bigint>>"
    turns = F.coalesce("turns", F.array().cast(of_turn))
    chunks = published(
        sequences.select(
            "conv_id", turns.getField("id").alias("ids"), turns.getField("words").alias("n_words"),
            F.shiftright("conv_id", CHUNK_BITS).alias("chunk"),
        )
        .groupBy("ids", "chunk")
        .agg(
            F.any_value("n_words").alias("n_words"), F.count("*").alias("n"), F.min("conv_id").alias("first"),
            F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("members"),
        ),
        "sequences",
    )
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = chunks.repartitionByRange(shards, "ids").sortWithinPartitions("ids", "chunk")
    found = published(
        dealt.select("ids", "n_words", "n", "first", "members").mapInArrow(sharded, NODE), "trie", "open"
    )
    done, edges = [found.where("NOT open")], found.where("open")
    count = edges.agg(F.count_distinct("shard"), F.max("shard")).first()
    left, width = count[0], (count[1] or 0) + 1
    while left:
        width = -(-width // RUN)
        whole = width == 1

        runs = edges.groupBy(F.floor(F.col("shard") / RUN).alias("run")).applyInArrow(of_run(whole), NODE)
        found = published(runs, "trie_edges", "open")
        done.append(found.where("NOT open"))
        edges, left = found.where("open"), 0 if whole else width
    nodes = done[0]
    for more in done[1:]:
        nodes = nodes.union(more)
    parents = nodes.where("key IS NOT NULL").select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_parent"))
    waiting = nodes.where("parent_key IS NOT NULL").join(parents, "parent_key", "left").withColumn("parent_conv_id", F.col("_parent"))
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    ends = F.coalesce("ends_sha256", F.lit(NO_MEMBERS)).alias("ends_sha256")
    return nodes.where("parent_key IS NULL").select(*out, ends).union(waiting.select(*out, ends))


def rebuilt(turns: DataFrame, every: int = 20, most: int = 3) -> DataFrame:
    """Conversations that continue the first one of their block of ``every`` ids.

    Conversation c takes the first h turns of conversation c - c % every (all if there are fewer, none if
    it does not exist), then its own turns after its first h; h = crc32(c as text) % (most + 1).
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int")
    heads = turns.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("head")
    )
    own = turns.withColumns({"base": F.col("conv_id") - F.col("conv_id") % every, "h": h})
    none = F.array().cast(dict(turns.dtypes)["turns"])
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    head = F.slice(F.coalesce("head", none), F.lit(1), F.col("h"))
    return own.join(heads, "base", "left").select("conv_id", F.concat(head, rest).alias("turns"))
