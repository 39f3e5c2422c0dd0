"""Exact deduplication: whole texts in Patricia tries that own the smallest identifier of each text."""

from __future__ import annotations

import os
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import salted_join
from .arrays import ids_of
from .store import written

#: Bytes of labels that a trie holds before it spills its largest subtree.
TRIE_BYTES = 64 << 20
#: Copies of a text within one input task from which it takes the salted round.
HOT_COPIES = 8
#: What a node costs beside its label.
NODE_BYTES = 250
SALTS = 64
#: A text is hot in the join of rows with owners when it has more than this share of all rows (1/1000).
#: So at most a thousand texts are, which bounds the table of them.
HOT_SHARE = 1000
KEYED = "text_sha256 string, length long, content_hash long, norm binary, keep_id long, group_size long"


class Node:
    """A stretch of bytes; ``owner`` is set where a text ends, ``file`` where a subtree was spilled."""

    __slots__ = ("label", "children", "owner", "file")

    def __init__(self, label: bytes, owner: list | None = None):
        self.label = label
        self.children: dict[int, Node] = {}
        self.owner = owner
        self.file = None


class PatriciaTrie:
    """A compressed radix trie over byte strings, bounded in memory.

    An owner is [smallest id, rows, tag]. Past ``limit`` bytes the largest subtree below the first branch
    goes to a file; later strings of that subtree are appended to it, and the file is read into a trie of
    its own at the end, which may spill in turn.
    """

    def __init__(self, limit: int = TRIE_BYTES):
        self.limit, self.root, self.bytes = limit, Node(b""), 0

    def insert(self, text: bytes, keep: int, size: int, tag: tuple) -> None:
        node, at, n = self.root, 0, len(text)
        while at < n:
            child = node.children.get(text[at])
            if child is None:
                node.children[text[at]] = Node(text[at:], [keep, size, tag])
                self.bytes += n - at + NODE_BYTES
                break
            if child.file is not None:
                pickle.dump((text[at + 1 :], keep, size, tag), child.file)
                return
            label = child.label
            if not text.startswith(label, at):
                same = len(os.path.commonprefix([label, text[at : at + len(label)]]))
                upper = Node(label[:same])
                child.label = label[same:]
                upper.children[label[same]] = child
                node.children[text[at]] = child = upper
                self.bytes += NODE_BYTES  # no spill before the text has its place below the new node
            node, at = child, at + len(child.label)
        else:
            owner = node.owner
            node.owner = [keep, size, tag] if owner is None else [min(owner[0], keep), owner[1] + size, owner[2]]
        if self.bytes > self.limit:
            self._spill()

    def _spill(self) -> None:
        node = self.root
        while len(node.children) == 1 and (only := next(iter(node.children.values()))).children:
            node = only
        held = {k: sum(len(x.label) + NODE_BYTES for _, x in self._nodes(c, b"")) for k, c in node.children.items() if c.file is None}
        first = max(held, key=held.get, default=None)
        if first is None or len(held) < 2 and not node.children[first].children:
            return  # a single text is left, and spilling it would gain nothing
        gone = Node(bytes([first]))
        gone.file = tempfile.TemporaryFile(dir=os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None)  # where Spark spills
        for text, part in self._nodes(node.children[first], b""):
            if part.file is not None:
                part.file.seek(0)
                for below, *owner in _records(part.file):
                    pickle.dump(((text + below)[1:], *owner), gone.file)
                part.file.close()
            elif part.owner is not None:
                pickle.dump((text[1:], *part.owner), gone.file)
        node.children[first] = gone
        self.bytes -= held[first]

    @staticmethod
    def _nodes(node: Node, above: bytes) -> Iterator[tuple[bytes, Node]]:
        stack = [(node, above)]
        while stack:
            node, above = stack.pop()
            whole = above + node.label
            yield whole, node
            stack += [(child, whole) for child in node.children.values()]

    def owners(self) -> Iterator[tuple[bytes, list]]:
        """Every distinct text with its owner; spilled subtrees come last, one at a time."""
        files = []
        for text, node in self._nodes(self.root, b""):
            if node.file is not None:
                files.append((text, node.file))
            elif node.owner is not None:
                yield text, node.owner
        self.root, self.bytes = Node(b""), 0
        for above, file in files:
            file.seek(0)
            below = PatriciaTrie(self.limit)
            for record in _records(file):
                below.insert(*record)
            file.close()
            for text, owner in below.owners():
                yield above + text, owner


def _records(file) -> Iterator[tuple]:
    while True:
        try:
            yield pickle.load(file)
        except EOFError:
            return


def normalised(text: str = "text"):
    """The text with each run of white space replaced by one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Feed the rows of a task to one trie; one row for each distinct text comes out."""
    trie = PatriciaTrie()
    for batch in batches:
        tags = zip(*(batch.column(c).to_pylist() for c in ("text_sha256", "length", "content_hash")))
        texts, sizes = batch.column("norm").to_pylist(), batch.column("group_size").to_pylist()
        for text, keep, size, tag in zip(texts, ids_of(batch.column("keep_id")).tolist(), sizes, tags):
            trie.insert(text, keep, size, tag)
    held, weight = [], 0
    for text, (keep, size, tag) in trie.owners():
        held.append((*tag, text, keep, size))
        weight += len(text) + 100
        if weight > 4 << 20:
            yield _batch(held)
            held, weight = [], 0
    if held:
        yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
    names = ["text_sha256", "length", "content_hash", "norm", "keep_id", "group_size"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def text_owners(keyed: DataFrame) -> DataFrame:
    """One row per distinct text: text_sha256, keep_id, group_size.

    Each input task collapses its own copies in a trie before anything is shuffled; partitions are then
    dealt by length and content hash. A text with many copies in a task is dealt over ``SALTS`` tasks too,
    and the few owners of its salts are summed up by digest and length.
    """
    local = keyed.mapInArrow(_collapse, KEYED)
    salt = F.when(F.col("group_size") >= HOT_COPIES, F.pmod(F.hash("keep_id"), F.lit(SALTS))).otherwise(F.lit(-1))
    dealt = local.withColumn("salt", salt).repartition("length", "content_hash", "salt").drop("salt")
    owned = dealt.mapInArrow(_collapse, KEYED).select("text_sha256", "length", "keep_id", "group_size")
    return owned.groupBy("text_sha256", "length").agg(F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """Which row of each group of equal texts stays.

    ``docs`` has doc_id and text. Texts are equal when identical after each run of white space is replaced
    by one space; a null text counts as empty and equals an empty one. Result, one row per row of
    ``docs``: doc_id, keep_id (smallest doc_id of the group), group_size, kept, text_sha256. Repeated rows
    of the smallest id are all kept. A null doc_id sorts behind all others; a group of such rows only has
    a null keep_id and stays. Other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised().alias("norm"))
    rows = rows.withColumn("text_sha256", F.sha2("norm", 256))
    keyed = rows.select(
        "text_sha256", F.octet_length("norm").cast("long").alias("length"), F.xxhash64("norm").alias("content_hash"),
        F.col("norm").cast("binary").alias("norm"), F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
    )
    missing = F.lit(2**63 - 1).cast("long")
    # written once: the hot texts are told from it, and the rows then meet their owners
    owners = written(text_owners(keyed).withColumn("keep_id", F.nullif("keep_id", missing)).drop("length"), "owners")
    total = owners.agg(F.sum("group_size")).first()[0] or 1
    share = F.col("group_size") * F.lit(HOT_SHARE) / F.lit(total)
    hot = owners.filter(share > 1).select("text_sha256", F.ceil(share).cast("int").alias("_salts"))
    lean = rows.select("doc_id", "text_sha256")
    return salted_join(lean, owners, ["text_sha256"], hot=hot).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )
