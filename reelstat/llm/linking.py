"""From candidate buckets to classes: verified links and distributed union-find, in DataFrame functions.

Members of a bucket are compared with its hub, the member that meets most others over all
its buckets (the text that many near copies come from): a large group costs as many comparisons as it has
members. Then only buckets whose members lie in different classes are looked at again. Up to ``SMALL_BUCKET`` members,
every pair of different classes is compared. In a larger one the hub of those outside the first hub's class that was
not tried yet is compared with all of other classes, in up to ``rounds`` rounds, as long as a round brings links.
What is left are large buckets of members that mostly are not similar, only alike enough to share a key. They are dealt out anew
by longer keys (``refine``), of which dissimilar members share hardly any, and go through the same steps. Members of
large buckets of these that still are of different classes meet in an exact prefix-filter join: at the rarest token they share, which
for similar sets is one of their first, and only where its places leave room for the similarity.
So no pairs of a whole large group are listed, and every link of two members of a last bucket is found.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelstat.llm.common import written
from reelstat.session import forget

# a written table of ids below this size may be broadcast to keep whole texts from being shuffled; a larger one is joined
BROADCAST_BYTES = 16_000_000
_WIDTHS = {T.LongType: 8, T.IntegerType: 4, T.BooleanType: 1, T.DoubleType: 8, T.BinaryType: 32}


def width(kind: T.DataType) -> int:
    """Bytes of a value of a type as it is used here: digests are the longest binaries, hex digests the longest strings."""
    if isinstance(kind, T.StructType):
        return 8 + sum(width(f.dataType) for f in kind.fields)
    return _WIDTHS.get(type(kind), 80)


def small(df: DataFrame) -> DataFrame:
    """``df``, which must be a written table, marked for broadcast if its bytes are few enough for it."""
    return F.broadcast(df) if df.count() * width(df.schema) <= BROADCAST_BYTES else df


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) of the connected components of the links (a, b); root is the least node, which has no row itself.

    Alternates the large-star and small-star steps until nothing changes; each step's
    edges are written to the shared folder and take the place of the last ones. Ids can be of any type with an order. No links give no rows.
    """
    edges = written(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        hooked = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        last, edges = edges, written(hooked.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct(), "edges")
        forget(last)
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def shared_buckets(rows: DataFrame) -> DataFrame:
    """Of the rows (h, ...), of which an id has each ``h`` once at most, those whose bucket has at least two."""
    buckets = written(rows.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "buckets")
    return rows.join(small(buckets), "h")


SMALL_BUCKET = 16
EARLIER = 64  # so many of the shared tokens before a token of a prefix go with it


def _hubs(members: DataFrame, name: str) -> DataFrame:
    """(h, hub, hub_label) of written members (h, id, label, degree): the greatest degree, then the greatest id."""
    best = members.groupBy("h").agg(F.max(F.struct("degree", "id", "label")).alias("m"))
    return written(best.select("h", F.col("m.id").alias("hub"), F.col("m.label").alias("hub_label")), name)


def _mixed(members: DataFrame) -> DataFrame:
    """Buckets with members of different classes: (h, n)."""
    sums = members.groupBy("h").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("n"))
    return written(sums.where("lo <> hi").select("h", "n"), "mixed-buckets")


def _pairs(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _meetings(unresolved: DataFrame, tokens: Callable[[DataFrame], DataFrame], similarity: float) -> DataFrame:
    """Pairs (a, b) of written (id, size, label) of different classes that hold all of Jaccard ``similarity`` or more, some more than once.

    Tokens are put in the order of their frequency. Sets with so much in common share one of their first
    size - similarity * size + 1 tokens. They meet at the first token they share, not at every one: a token goes with the ``EARLIER``
    first ones before it that any other set has, and sets that share one of those do not meet here (they did there). Nothing before the
    first shared token is common, so what comes from it on bounds what they can have in common; of tokens past ``EARLIER`` this is not known.
    """
    listed = written(tokens(unresolved.select("id")), "tokens")
    met = listed.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sets = (
        listed.join(met, "token", "left")
        .groupBy("id")
        .agg(F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(1)).alias("n"), "token"))).alias("set"))
        .withColumn("size", F.size("set"))
        .join(unresolved.select("id", "label"), "id")
    )
    first = F.col("size") - F.ceil(F.col("size") * similarity - 1e-9) + 1
    head = F.transform(F.slice("set", F.lit(1), first.cast("int")), lambda t, i: F.struct(i.alias("place"), t["n"].alias("n"), t["token"].alias("token")))
    heads = sets.select("id", "size", "label", F.filter(head, lambda t: t["n"] > 1).alias("head"))
    prefixes = heads.select("id", "size", "label", F.slice("head.token", 1, EARLIER).alias("begin"), F.posexplode("head").alias("rank", "t"))
    prefixes = prefixes.select("id", "size", "label", "t.place", "rank", "t.token", F.slice("begin", F.lit(1), F.col("rank")).alias("before"))
    prefixes = written(prefixes, "prefixes")
    forget(listed)
    mixed = prefixes.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("token")
    prefixes = prefixes.join(mixed, "token")
    side = lambda i, c: prefixes.select("token", *[F.col(x).alias(y) for x, y in zip(("id", "size", "label", "place", "rank", "before"), (i, *(f"{x}{c}" for x in "slprb")))])
    past = lambda p: F.greatest(F.col(p) - EARLIER, F.lit(0))
    unseen = F.least("rx", "ry", past("rx") + past("ry"))
    common = unseen + F.least(F.col("sx") - F.col("px"), F.col("sy") - F.col("py"))
    enough = common >= similarity / (1 + similarity) * (F.col("sx") + F.col("sy")) - 1e-9
    apart = ~F.arrays_overlap("bx", "by")
    return side("x", "x").join(side("y", "y"), "token").where((F.col("lx") < F.col("ly")) & enough & apart).select(*_pairs("x", "y"))


@dataclass
class _Found:
    """What is known so far: verified links, classes from them (None: each its own), and the pairs that were compared."""

    verify: Callable[[DataFrame], DataFrame]
    links: DataFrame | None = None
    classes: DataFrame | None = None
    done: DataFrame | None = None

    def compare(self, pairs: DataFrame) -> bool:
        """Verify the pairs (a, b) not compared before; whether that brought a link."""
        fresh = written(pairs if self.done is None else pairs.join(self.done, ["a", "b"], "left_anti"), "pairs")
        if fresh.isEmpty():
            return False
        self.done = fresh if self.done is None else self.done.unionByName(fresh)
        more = written(self.verify(fresh), "links")
        if more.isEmpty():
            self.links = more if self.links is None else self.links
            return False
        self.links = more if self.links is None else self.links.unionByName(more)
        self.classes = components(self.links)
        return True

    def labelled(self, members: DataFrame) -> DataFrame:
        """``members`` (h, id, size, degree) with the ``label`` of their class."""
        if self.classes is None:
            return written(members.withColumn("label", F.col("id")), "labelled")
        named = members.join(self.classes.withColumnRenamed("node", "id"), "id", "left")
        return written(named.select("h", "id", "size", "degree", F.coalesce("root", "id").alias("label")), "labelled")


def _large(members: DataFrame, mixed: DataFrame) -> DataFrame:
    return members.join(mixed.where(F.col("n") > SMALL_BUCKET).select("h"), "h")


def _link_buckets(members: DataFrame, found: _Found, least_ratio: float, rounds: int) -> DataFrame:
    """Hubs, small buckets, further hubs; gives written (id, size) of what large buckets of several classes still hold."""
    sizes = members.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    degrees = members.join(sizes, "h").groupBy("id").agg(F.sum("n").alias("degree"))
    members = written(members.join(degrees, "id"), "degrees")
    labelled = found.labelled(members)
    hubs = _hubs(labelled, "hubs")
    found.compare(labelled.join(hubs, "h").where(F.col("label") != F.col("hub_label")).select(*_pairs("hub", "id")).distinct())
    tried = hubs.select("h", F.col("hub").alias("id"))
    forget(labelled)
    labelled = found.labelled(members)
    mixed = _mixed(labelled)
    few = labelled.join(mixed.where(F.col("n") <= SMALL_BUCKET).select("h"), "h")
    left = few.select("h", F.col("id").alias("x"), F.col("size").alias("sx"), F.col("label").alias("lx"))
    right = few.select("h", F.col("id").alias("y"), F.col("size").alias("sy"), F.col("label").alias("ly"))
    close = F.least("sx", "sy") >= F.lit(least_ratio) * F.greatest("sx", "sy")
    wanted = left.join(right, "h").where(close & (F.col("lx") < F.col("ly"))).select(*_pairs("x", "y"))
    for k in range(rounds):
        # the next hub of a large bucket's members outside the class of the first hub, against all of other classes
        many = _large(labelled, mixed)
        outside = many.join(_hubs(many, "hubs").select("h", "hub_label"), "h").where(F.col("label") != F.col("hub_label"))
        fresh = _hubs(outside.drop("hub_label").join(tried, ["h", "id"], "left_anti"), "outside-hubs")
        tried = tried.unionByName(fresh.select("h", F.col("hub").alias("id")))
        again = many.join(fresh, "h").where(F.col("label") != F.col("hub_label")).select(*_pairs("hub", "id"))
        more = found.compare((wanted.unionByName(again) if k == 0 else again).distinct())
        if not more:
            break
        last = labelled
        labelled = found.labelled(members)
        forget(last, mixed)
        mixed = _mixed(labelled)
    left_over = written(_large(labelled, mixed).select("id", "size", "label").distinct(), "unresolved")
    forget(members, labelled, mixed)
    return left_over


def link_classes(
    members: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    least_ratio: float,
    rounds: int = 4,
    *,
    tokens: Callable[[DataFrame], DataFrame],
    refine: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(links, classes) of written members (h, id, size).

    ``verify`` takes pairs (a, b) and keeps those that are similar. ``least_ratio`` is the least Jaccard
    similarity of these, so also the smaller by the larger size that similar members have at least (equal sizes: not known). ``tokens`` takes ids (id)
    and gives the different tokens (id, token) of their sets. ``refine`` takes ids and gives their longer
    keys (h, id), each once.
    """
    found = _Found(verify)
    unresolved = _link_buckets(members, found, least_ratio, rounds)
    if refine is not None and not unresolved.isEmpty():
        again = written(shared_buckets(refine(unresolved.select("id"))).join(unresolved.select("id", "size"), "id"), "refined-members")
        unresolved = _link_buckets(again, found, least_ratio, rounds)
    if not unresolved.isEmpty():
        found.compare(_meetings(unresolved, tokens, least_ratio).distinct())
    if found.links is None:
        found.links = members.select(F.col("id").alias("a"), F.col("id").alias("b")).where("false")
    return found.links, found.classes if found.classes is not None else components(found.links)
