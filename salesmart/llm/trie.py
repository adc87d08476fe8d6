"""Prefix trie of conversations, its subtree totals by time-forward processing.

A turn is a mark (128 bits of the SHA-256 of role and text); a prefix's key is
a polynomial of its marks modulo 2^127 - 1 in a base drawn anew for each run,
so two different prefixes share a key with probability below length / 2^127
whatever the texts. Keys are a scan over rows dealt by range of (conversation,
turn): a task sums its own rows from zero, and what a conversation had summed
before its cut is added afterwards. That is at most one number a task, so a
conversation with a third of all rows is many tasks. Texts are never moved.

A node is a distinct (depth, key). Its members and smallest member come from
one aggregate; subtree totals go from children to parents:

* a node over more than ``SHARD`` turns (counted with repeats, so never fewer
  than the nodes below it) is of a higher tier, over ``SHARD * FAN`` of the
  next one, and so on. Maximal subtrees of one tier are the shards
* tier by tier, every shard's nodes are sorted by reverse level order (Spark's
  external sort) and read once; each node takes its children's messages from a
  priority queue that spills to disk, and sends its totals to its parent by it
* totals of shard roots are added per parent and enter that parent's shard in
  the next tier; the root of all comes last

Defined cases
* null role or text is empty; turns are ordered by number, nulls first, ties by mark
* rows without conv_id are no conversation; repeated rows are turns like others
* a conversation that is left without turns is a member of the root only
* no rows in, no rows out; other columns are ignored
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import secrets
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import WORD, cut, partitions, written
from salesmart.llm.merkle import crc32_sql
from salesmart.llm.ranks import dealt_by_range, ranked

PRIME = (1 << 127) - 1
ROOT = bytes(16)
SHARD = 1024
FAN = 1024
QUEUE = 200_000  # messages that a queue holds in memory
LISTED = 4096  # ids in one piece of a node's list
GROUP, HEADS = 20, 4
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def marked(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, mark, words of every turn."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.unhex(F.substring(F.sha2(whole, 256), 1, 32)).alias("mark"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))


def rebuilt(conversations: DataFrame, group: int = GROUP, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """(turns: conv_id, depth, length, mark, words; all conversations: conv_id, length).

    Conversation c starts with the first h turns of conversation c - c % ``group``
    and goes on with its own turns after its first h, h = crc32(c) % ``heads``.
    """
    turns = cut(ranked(written(marked(conversations), "trie-turns"), "conv_id", ["turn", "mark"], "trie-places"))
    sizes = turns.filter("place = 0").select("conv_id", "size")
    convs = sizes.select("conv_id", "size", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).alias("h"),
                         (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
    convs = convs.join(sizes.select(F.col("conv_id").alias("base"), F.col("size").alias("base_size")), "base", "left")
    convs = convs.withColumn("taken", F.least("h", F.coalesce("base_size", F.lit(0))))
    convs = cut(convs.select("conv_id", "base", "h", "taken", (F.col("taken") + F.greatest(F.col("size") - F.col("h"), F.lit(0))).alias("length")))
    own = turns.join(convs, "conv_id").filter("place >= h").select(
        "conv_id", (F.col("place") - F.col("h") + F.col("taken") + 1).alias("depth"), "length", "mark", "words")
    first = turns.filter(F.col("place") < heads - 1).select(F.col("conv_id").alias("base"), "place", "mark", "words")
    wanted = convs.filter("taken > 0").select("conv_id", "base", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("taken") - 1)).alias("place"))
    shared = wanted.join(first, ["base", "place"]).select("conv_id", (F.col("place") + 1).alias("depth"), "length", "mark", "words")
    return written(own.unionByName(shared), "trie-rebuilt"), convs.select("conv_id", "length")


def _carried(spans: list, prime: int = PRIME) -> dict[int, tuple[int, int]]:
    """Task -> (conversation, sum before it), for tasks that begin within a conversation."""
    carry, conv, total = {}, None, 0
    for s in sorted(spans, key=lambda s: s["task"]):
        if s["first"]["depth"] > 1 and s["first"]["conv_id"] == conv:
            carry[s["task"]] = (conv, total)
        if s["last"]["conv_id"] != conv:
            conv, total = s["last"]["conv_id"], 0
        total = (total + int.from_bytes(s["last"]["key"], "big")) % prime
    return carry


def prefix_keys(turns: DataFrame, base: int | None = None) -> DataFrame:
    """conv_id, depth, length, words, key, parent (the key one turn earlier)."""
    base = base or secrets.randbelow(PRIME - 1000) + 500
    schema = "conv_id long, depth long, length long, words long, key binary, parent binary, task int"

    def scan(batches):
        task, conv, total, power = TaskContext.get().partitionId(), None, 0, 0
        for batch in batches:
            keys, parents = [], []
            for c, d, m in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "depth", "mark")), strict=True):
                if c == conv:
                    power = power * base % PRIME
                else:
                    conv, total, power = c, 0, pow(base, d, PRIME)
                parents.append(total.to_bytes(16, "big"))
                total = (total + int.from_bytes(m, "big") * power) % PRIME
                keys.append(total.to_bytes(16, "big"))
            yield pa.record_batch([*[batch.column(n) for n in ("conv_id", "depth", "length", "words")], pa.array(keys, pa.binary()), pa.array(parents, pa.binary()),
                                   pa.array([task] * len(keys), pa.int32())], names=["conv_id", "depth", "length", "words", "key", "parent", "task"])

    local = written(dealt_by_range(turns, ["conv_id", "depth"]).mapInArrow(scan, schema), "trie-keys")
    # one row per task of the scan
    spans = local.groupBy("task").agg(F.min(F.struct("conv_id", "depth")).alias("first"), F.max(F.struct("conv_id", "depth", "key")).alias("last")).collect()
    carry = _carried(spans)
    if not carry:
        return local.drop("task")

    def shift(batches):
        for batch in batches:
            rows = list(zip(*(batch.column(n).to_pylist() for n in ("task", "conv_id", "key", "parent")), strict=True))
            add = [carry[t][1] if t in carry and carry[t][0] == c else 0 for t, c, _, _ in rows]
            moved = [[k if not a else ((int.from_bytes(k, "big") + a) % PRIME).to_bytes(16, "big") for k, a in zip(column, add, strict=True)]
                     for column in ([r[2] for r in rows], [r[3] for r in rows])]
            yield pa.record_batch([*[batch.column(n) for n in ("conv_id", "depth", "length", "words")], *[pa.array(m, pa.binary()) for m in moved]],
                                  names=["conv_id", "depth", "length", "words", "key", "parent"])
    return local.mapInArrow(shift, schema.removesuffix(", task int"))


class MessageQueue:
    """Priority queue of tuples; beyond ``limit`` they go to temporary files as sorted runs."""

    def __init__(self, limit: int = QUEUE):
        self.limit, self.heap, self.runs, self.spilled = limit, [], [], 0

    def push(self, message: tuple) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.limit:
            run = self._stored(sorted(self.heap))
            self.heap = []
            self.spilled += 1
            heapq.heappush(self.runs, (next(run), self.spilled, run))

    @staticmethod
    def _stored(messages: list[tuple], block: int = 4096) -> Iterator[tuple]:
        file = tempfile.TemporaryFile()
        for at in range(0, len(messages), block):
            pickle.dump(messages[at:at + block], file)
        left = -(-len(messages) // block)
        messages.clear()
        file.seek(0)

        def read():
            with file:
                for _ in range(left):
                    yield from pickle.load(file)
        return read()

    def take(self, head: tuple) -> Iterator[tuple]:
        """Remove and return the messages that start with ``head``; no smaller ones may be left."""
        n = len(head)
        while self.heap and self.heap[0][:n] == head:
            yield heapq.heappop(self.heap)
        while self.runs and self.runs[0][0][:n] == head:
            message, k, run = self.runs[0]
            following = next(run, None)
            if following is None:
                heapq.heappop(self.runs)
            else:
                heapq.heapreplace(self.runs, (following, k, run))
            yield message

    def __len__(self) -> int:
        return len(self.heap) + len(self.runs)


_SETTLED = "depth long, key binary, parent binary, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, top boolean"


def settled(nodes: DataFrame, queue: int = QUEUE) -> DataFrame:
    """Subtree totals of the nodes of all shards; ``children``, ``leaves`` and ``saved`` come from lower tiers."""
    names = ["shard", "depth", "key", "parent", "conv_id", "n_convs", "words", "children", "leaves", "saved"]

    def run(batches):
        shard, messages = None, MessageQueue(queue)
        for batch in batches:
            out = []
            for own, depth, key, parent, conv, convs, words, children, leaves, saved in zip(
                    *(batch.column(n).to_pylist() for n in names), strict=True):
                if own != shard:
                    if len(messages):
                        raise RuntimeError("a shard ended with messages left")
                    shard = own
                for _, _, c, n, s in messages.take((-depth, key)):
                    children, leaves, saved = children + c, leaves + n, saved + s
                leaves = leaves or 1
                saved += (convs - 1) * words
                top = key == shard
                if not top:
                    messages.push((1 - depth, parent, 1, leaves, saved))
                out.append((depth, key, parent, conv, convs, children, leaves, saved, top))
            columns = list(zip(*out, strict=True)) or [[]] * 9
            kinds = [pa.int64(), pa.binary(), pa.binary(), *[pa.int64()] * 5, pa.bool_()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                  names=["depth", "key", "parent", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "top"])

    dealt = nodes.select(*names).repartition(partitions(nodes.sparkSession), "shard")
    return dealt.sortWithinPartitions("shard", F.col("depth").desc(), "key").mapInArrow(run, _SETTLED)


def _passed_on(outs: list[DataFrame]) -> DataFrame:
    """Totals of shard roots by the parent they go to: depth, key, children, leaves, saved."""
    tops = outs[0].filter("top")
    for out in outs[1:]:
        tops = tops.unionByName(out.filter("top"))
    return tops.groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("key")).agg(
        F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))


def listed(members: DataFrame) -> DataFrame:
    """depth, key, ends_sha256 of (depth, key, conv_id): SHA-256 of the ascending ids, comma-joined.

    Tasks join runs of ids dealt by range; only these texts meet at their node, where they are hashed as they pass.
    """
    def pieces(batches):
        head, ids = None, []
        for batch in batches:
            out = []
            for depth, key, conv in zip(*(batch.column(n).to_pylist() for n in ("depth", "key", "conv_id")), strict=True):
                if ids and (head != (depth, key) or len(ids) == LISTED):
                    out.append((*head, ids[0], ",".join(map(str, ids))))
                    ids = []
                head = (depth, key)
                ids.append(conv)
            yield _piece_batch(out)
        if ids:
            yield _piece_batch([(*head, ids[0], ",".join(map(str, ids)))])

    def _piece_batch(rows):
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.binary(), pa.int64(), pa.string()), strict=True)],
                               names=["depth", "key", "first", "text"])

    def digests(batches):
        head, state = None, None

        def closed(rows):
            columns = list(zip(*rows, strict=True)) or [[]] * 3
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.binary(), pa.string()), strict=True)],
                                   names=["depth", "key", "ends_sha256"])
        for batch in batches:
            out = []
            for depth, key, text in zip(*(batch.column(n).to_pylist() for n in ("depth", "key", "text")), strict=True):
                if head == (depth, key):
                    state.update(b"," + text.encode())
                else:
                    if head:
                        out.append((*head, state.hexdigest()))
                    head, state = (depth, key), hashlib.sha256(text.encode())
            yield closed(out)
        if head:
            yield closed([(*head, state.hexdigest())])

    found = dealt_by_range(members, ["depth", "key", "conv_id"]).mapInArrow(pieces, "depth long, key binary, first long, text string")
    return (found.repartition(partitions(members.sparkSession), "depth", "key").sortWithinPartitions("depth", "key", "first")
            .mapInArrow(digests, "depth long, key binary, ends_sha256 string"))


def prefix_trie(turns: DataFrame, convs: DataFrame, shard: int = SHARD, fan: int = FAN, queue: int = QUEUE) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns``: conv_id, depth (from 1), length (of the conversation), mark, words; ``convs``: conv_id, length of all.
    """
    keyed = prefix_keys(turns)
    tier = sum((F.when(F.col("below") > shard * fan ** k, 1).otherwise(0) for k in range(6) if shard * fan ** k < 1 << 62), F.lit(0))
    nodes = cut(keyed.groupBy("depth", "key").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("parent").alias("parent"), F.min("words").alias("words"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("below")).withColumn("tier", tier))
    highest = nodes.agg(F.max("tier")).first()[0]
    if highest:
        placed = keyed.select("conv_id", "depth", "key").join(nodes.select("depth", "key", "tier"), ["depth", "key"])
        shards = placed.groupBy("conv_id", "tier").agg(F.min(F.struct("depth", "key")).alias("at")).select("conv_id", "tier", F.col("at.key").alias("shard"))
    else:
        shards = keyed.filter("depth = 1").select("conv_id", F.lit(0).alias("tier"), F.col("key").alias("shard"))
    sharded = nodes.join(shards, ["conv_id", "tier"])
    if highest:
        sharded = cut(sharded)
    outs: list[DataFrame] = []
    for t in range((highest or 0) + 1):
        own = sharded.filter(F.col("tier") == t)
        if outs:
            own = own.join(_passed_on(outs), ["depth", "key"], "left")
        else:
            own = own.withColumns(dict.fromkeys(("children", "leaves", "saved"), F.lit(0)))
        outs.append(cut(settled(own.fillna(0, ["children", "leaves", "saved"]), queue)))
    rows = outs[0]
    for out in outs[1:]:
        rows = rows.unionByName(out)

    members = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    sums = rows.filter("depth = 1").agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    # both have one row
    root = cut(members.join(F.broadcast(sums), F.lit(True)).select(
        "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children",
        F.coalesce("leaves", F.lit(1)).alias("n_leaves"), F.coalesce("saved", F.lit(0)).alias("saved_tokens"), F.lit(ROOT).alias("key")))
    first = root.select("conv_id").first()
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "key"]
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    deep = rows.filter("depth > 1").join(parents, ["depth", "parent"]).select(*columns)
    shallow = rows.filter("depth = 1").withColumn("parent_conv_id", F.lit(first[0] if first else None).cast("long")).select(*columns)
    ends = listed(keyed.filter("depth = length").select("depth", "key", "conv_id").unionByName(
        convs.filter("length = 0").select(F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("key"), "conv_id")))
    return root.select(*columns).unionByName(shallow).unionByName(deep).join(ends, ["depth", "key"], "left").select(
        *columns[:-1], F.coalesce("ends_sha256", F.lit(_NO_ENDS)).alias("ends_sha256"))


def op11_prefix_trie(spark, sf_dir):
    """The prefix trie of all conversations, rebuilt on the heads of their groups."""
    return prefix_trie(*rebuilt(spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet")))


ORACLE = f"""
WITH turns AS MATERIALIZED (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS MATERIALIZED (
  SELECT conv_id, count(*) AS size, {crc32_sql('conv_id::VARCHAR')} % 4 AS h, conv_id - conv_id % 20 AS base FROM turns GROUP BY conv_id
), made AS (
  SELECT c.conv_id, t.place AS nth, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.place < c.h
  UNION ALL
  SELECT c.conv_id, t.place + 1000000 AS nth, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.place >= c.h
), steps AS MATERIALIZED (
  SELECT conv_id, row_number() OVER w AS depth, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words,
         string_agg(strlen(role) || ':' || strlen(text) || ':' || role || text, '') OVER (PARTITION BY conv_id ORDER BY nth ROWS UNBOUNDED PRECEDING) AS key
  FROM made WINDOW w AS (PARTITION BY conv_id ORDER BY nth)
  UNION ALL
  SELECT conv_id, 0, 0, '' FROM convs
), ends AS (
  SELECT conv_id, max(depth) AS depth FROM steps GROUP BY conv_id
), nodes AS MATERIALIZED (
  SELECT depth, key, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
         coalesce(string_agg(CASE WHEN e.depth IS NOT NULL THEN r.conv_id::VARCHAR END, ',' ORDER BY r.conv_id), '') AS listed
  FROM steps r LEFT JOIN ends e USING (conv_id, depth) GROUP BY depth, key
), up AS MATERIALIZED (
  SELECT DISTINCT b.depth, b.key, a.depth AS above, a.key AS above_key FROM steps a JOIN steps b USING (conv_id) WHERE a.depth <= b.depth
), inner_nodes AS (
  SELECT DISTINCT above AS depth, above_key AS key FROM up WHERE above < depth
), totals AS (
  SELECT u.above AS depth, u.above_key AS key, sum((n.n_convs - 1) * n.words)::BIGINT AS saved_tokens,
         count(*) FILTER (i.key IS NULL) AS n_leaves, count(*) FILTER (u.depth = u.above + 1) AS n_children
  FROM up u JOIN nodes n ON n.depth = u.depth AND n.key = u.key LEFT JOIN inner_nodes i ON i.depth = u.depth AND i.key = u.key
  GROUP BY u.above, u.above_key
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, t.n_children, t.n_leaves, t.saved_tokens, sha256(n.listed) AS ends_sha256
FROM nodes n JOIN totals t ON t.depth = n.depth AND t.key = n.key
LEFT JOIN (SELECT u.depth, u.key, m.conv_id FROM up u JOIN nodes m ON m.depth = u.above AND m.key = u.above_key WHERE u.above = u.depth - 1) p
  ON p.depth = n.depth AND p.key = n.key
"""
