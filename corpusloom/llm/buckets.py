"""Links inside buckets without all pairs: hubs first, then an exact prefix join of what stays open.

A bucket is a set of nodes that share a band key.  First every member is compared with the least node of
its bucket; the links make components.  In buckets of at most ``few`` nodes all pairs of different components
meet, which is fewer than ``few`` for a node and bucket.  Members of larger ones with several components
meet ``HUBS`` of its largest component, ``PASSES`` times, which joins most of what belongs together.  A larger bucket
that then still holds several components is open.  Open nodes of different components are compared by a
prefix join (see :func:`prefix_pairs`): of each node's elements, ordered by how few open nodes have them,
only the first ones can hold the first element that a similar pair shares, so nodes meet only by elements
that are rare among the open ones.  A template that all of them share costs nothing.

Nodes that share such an element meet as members outside its largest component, with all others.  This is
exact: no step misses links of nodes that share a bucket.  An element that many nodes of many components have
gives pairs with the square of them; those that pass the bounds of size and place are kept, the others only
streamed, and the members of a key are dealt over tasks by ``SLICE``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import forget, written, written_parts
from corpusloom.llm.components import connected_components, merged

HUBS = 2
SLICE = 1024  # members of a key that one task compares with the others
PASSES = 2
RARE = 1024  # nodes that have an element which is looked up
FEW = 32  # nodes of a bucket in which all pairs meet


def packed(registers: list[str], bits: int) -> Column:
    """Array of longs that hold the last ``bits`` bits of each register."""
    each = 64 // bits
    part = lambda c, k: F.shiftleft(F.col(c).cast("long").bitwiseAND(F.lit((1 << bits) - 1)), bits * (k % each))
    return F.array(*[reduce(Column.bitwiseOR, [part(c, k) for k, c in enumerate(registers[p : p + each])]) for p in range(0, len(registers), each)])


def unpacked(packs: Column, k: Column, bits: int) -> Column:
    """Register number ``k`` of a pack."""
    each = 64 // bits
    place = k.bitwiseAND(F.lit(each - 1)) * bits
    return F.call_function("shiftrightunsigned", F.get(packs, F.shiftright(k, each.bit_length() - 1)), place).bitwiseAND(F.lit((1 << bits) - 1))


def agreed(a: Column, b: Column, count: int, bits: int) -> Column:
    """How many of ``count`` registers agree in two packs: all but the fields in which a bit differs.

    A field differs where the sum of its lower bits with as many ones reaches its first bit, or that bit differs.  Halves of a
    long are added, so no sum leaves it.  All of it is plain arithmetic, which Spark compiles.
    """
    first = sum(1 << (bits * k + bits - 1) for k in range(32 // bits))
    lower = first - sum(1 << (bits * k) for k in range(32 // bits))

    def differing(v: Column) -> Column:
        return F.bit_count((v.bitwiseAND(F.lit(lower)) + F.lit(lower)).bitwiseOR(v).bitwiseAND(F.lit(first)))

    halves = []
    for k in range(-(-count * bits // 64)):
        x = F.get(a, F.lit(k)).bitwiseXOR(F.get(b, F.lit(k)))
        halves += [differing(x.bitwiseAND(F.lit(0xFFFFFFFF))), differing(F.shiftrightunsigned(x, 32))]
    return count - reduce(Column.__add__, halves)


def may_share(a: Column, b: Column, n_a: Column, n_b: Column, least: float) -> Column:
    """Whether sets of ``n_a`` and ``n_b`` elements may have a Jaccard similarity of ``least``.  A bit of ``a`` and
    ``b`` (arrays of longs) is the parity of the elements that fall on it, so each bit that differs stands for an
    element that one set alone has: no similar pair is lost."""
    apart = F.aggregate(F.zip_with(a, b, lambda x, y: x.bitwiseXOR(y)), F.lit(0), lambda n, v: n + F.bit_count(v))
    return (n_a + n_b - apart) * (1 + least) >= 2 * least * (n_a + n_b) - 1e-6


def parities(elements: DataFrame, words: int) -> DataFrame:
    """``node, sign`` of ``node, element`` rows, the hashes of a set: ``n``, their number, and ``w0``, ``w1`` and so on,
    ``words`` longs of parities for :func:`may_share_few`."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("element").bitwiseAND(F.lit(63)).cast("int"))
    word = F.shiftrightunsigned("element", 6).bitwiseAND(F.lit(words - 1))
    own = [F.coalesce(F.bit_xor(F.when(word == k, bit)), F.lit(0)).alias(f"w{k}") for k in range(words)]
    return elements.groupBy("node").agg(F.count("element").alias("n"), *own).select("node", F.struct("n", *[f"w{k}" for k in range(words)]).alias("sign"))


def may_share_few(a: Column, b: Column, words: int, least: float) -> Column:
    """:func:`may_share` of two :func:`parities`: short enough for a join's condition that is compiled."""
    apart = reduce(Column.__add__, [F.bit_count(a[f"w{k}"].bitwiseXOR(b[f"w{k}"])) for k in range(words)])
    n = a["n"] + b["n"]
    return apart <= n * ((1 - least) / (1 + least)) + 1e-6


def shared_buckets(parts: Iterable[DataFrame], label: str) -> DataFrame:
    """``key, node, hub`` of the buckets of ``key, node`` rows that hold two nodes or more; no bucket has rows of
    several ``parts``.  Rows are dealt once, for their hubs and for the join with these."""

    def met(rows: DataFrame) -> DataFrame:
        dealt = rows.select("key", "node").repartition("key")
        hubs = dealt.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("last")).filter("hub < last").select("key", "hub")
        return dealt.join(hubs, "key").select("key", "node", "hub")

    return written_parts(map(met, parts), label)


def prefix_pairs(nodes: DataFrame, elements: DataFrame, least: float, label: str, some: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Pairs ``a, b`` of ``node, comp`` rows of different components that may have a Jaccard similarity of
    ``least``: all that have it are among them.

    ``elements`` has ``node, n, element``, a row for each of the ``n`` elements of a node's set.  Of a similar
    pair, the smaller set has the first common element, in order of rarity, within its first
    n - ceil(2 least / (1 + least) n) + 1, the larger one within its first n - ceil(least n) + 1, and from
    there on both have enough elements for what they must share.

    Only elements that up to ``RARE`` nodes have are looked up.  Those that more nodes have follow in the order of
    their hashes, so a node whose stretch reaches to them finds them as what is left of its set; ``some`` gives
    the elements of such ``node`` rows.
    """
    dealt = elements.select(F.xxhash64("node").alias("id"), F.col("n").cast("int").alias("n"), "element").filter("element is not null").repartition("element")
    counts = dealt.groupBy("element").agg(F.count("*").cast("int").alias("df"), F.min("id").alias("id"), F.min("n").alias("n"))
    reach = F.expr(f"int(n - ceil({least} * n - 1e-9)) + 1")  # the longest stretch to look at
    index = F.expr(f"int(n - ceil({2 * least / (1 + least)} * n - 1e-9)) + 1")  # that of the smaller set
    counts = counts.filter(f"id >= {-(2**63)} and n > 0")  # holds everywhere: all that follows reads the same columns of one exchange
    single = counts.filter("df = 1").select("id", "n", "df", "element")
    rare = dealt.join(counts.filter(f"df > 1 and df <= {RARE}").select("element", "df"), "element").select("id", "n", "df", "element")
    known = rare.unionByName(single).groupBy("id", "n").agg(F.count_if(F.col("df") == 1).alias("own"), F.array_sort(F.collect_list(F.struct("df", "element"))).alias("s"))
    in_order = F.transform("s", lambda x: x["element"])
    cut = F.when(F.size("s") >= reach, F.slice(in_order, 1, reach)).otherwise(in_order)  # all, where it is not enough
    first = written(known.select("id", "n", F.col("own").cast("int").alias("own"), cut.alias("s"), (F.size("s") >= reach).alias("enough")), f"{label}-rare")
    ids = nodes.withColumn("id", F.xxhash64("node"))
    short = written(ids.join(first.filter("enough"), "id", "left_anti").select("node"), f"{label}-short")
    stretches = first.filter("enough").select("id", "n", "own", "s")
    if not short.isEmpty():
        again = some(short) if some else elements.join(short, "node", "left_semi")
        whole = again.groupBy(F.xxhash64("node").alias("id")).agg(F.min("n").cast("int").alias("n"), F.collect_list("element").alias("all"))
        known = whole.join(first.filter("not enough").select("id", "own", "s"), "id", "left").withColumns({"own": F.coalesce("own", F.lit(0)), "s": F.coalesce("s", F.array().cast("array<bigint>"))})
        filled = F.slice(F.concat("s", F.array_sort(F.array_except("all", "s"))), 1, reach)
        stretches = stretches.unionByName(known.select("id", "n", "own", filled.alias("s")))
    keys = ids.join(stretches, "id").select("node", "comp", "n", "own", index.alias("index"), F.posexplode("s").alias("at", "key")).filter("at >= own")
    keyed = written(keys.select("node", "comp", "n", "at", "key", (F.col("at") < F.col("index")).alias("indexed")), f"{label}-keys")
    for old in (first, short):
        forget(old)
    per = keyed.groupBy("key", "comp").agg(F.count("*").alias("c")).groupBy("key").agg(F.sum("c").alias("all"), F.max("c").alias("most"), F.max_by("comp", F.struct("c", "comp")).alias("main"))
    slices = F.ceil((F.col("all") - F.col("most")) / SLICE).cast("int").alias("slices")
    outside = written(per.filter("all > most").select("key", "main", slices), f"{label}-outside")
    open_keys = keyed.join(outside, "key")
    some = open_keys.filter("comp <> main").withColumn("slice", F.pmod(F.xxhash64("node"), F.col("slices")).cast("int"))
    every = open_keys.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    pairs = written(_met(some, every, least), f"{label}-pairs")
    for old in (keyed, outside):
        forget(old)
    return pairs


def _met(some: DataFrame, every: DataFrame, least: float) -> DataFrame:
    """Pairs of ``some`` rows with ``every`` row of their key and slice that pass the bounds of size and place."""
    side = lambda rows, p: rows.select("key", "slice", *[F.col(c).alias(f"{c}_{p}") for c in ("node", "comp", "n", "at", "indexed")])
    x, y = F.struct("n_x", "node_x"), F.struct("n_y", "node_y")
    both = F.expr("least(n_x - at_x, n_y - at_y)")  # common elements from this one on, at most
    enough = both >= F.expr(f"ceil({least / (1 + least)} * (n_x + n_y) - 1e-9)")
    near = F.least("n_x", "n_y") >= least * F.greatest("n_x", "n_y") - 1e-9
    fits = (F.col("comp_x") != F.col("comp_y")) & near & enough & F.when(x > y, F.col("indexed_y")).otherwise(F.col("indexed_x"))
    met = side(some, "x").join(side(every, "y"), ["key", "slice"]).filter(fits)
    return met.select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b")).distinct()


def settled(shared: DataFrame, verify: Callable[[DataFrame], DataFrame], likely: Callable[[DataFrame], DataFrame], elements: Callable[[DataFrame], DataFrame], least: float, label: str, signs: Callable[[DataFrame], DataFrame] | None = None, near: Callable[[Column, Column], Column] | None = None, few: int = FEW) -> DataFrame:
    """``node, root`` of all nodes that have a link.

    ``shared`` has ``key, node, hub``; ``likely`` drops pairs ``a, b`` that are hopeless, ``verify`` keeps those
    that are similar; ``elements`` gives ``node, n, element`` of ``node`` rows.  With ``signs``, which gives ``node, sign`` of
    them, hopeless pairs of a bucket are told by ``near`` of both signs where they meet, so none of them moves and
    all pairs may meet in buckets of more nodes, ``few``.
    """
    stars = shared.filter("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    links = written(verify(likely(stars).select("a", "b")), f"{label}-links")
    roots = written(connected_components(links), f"{label}-roots")
    forget(links)
    for turn in range(1, PASSES + 1):
        still = written(_open(shared, roots, 2 if turn == 1 else few), f"{label}-open")
        if turn > 1 and still.isEmpty():
            forget(still)
            break
        known = written(signs(still.select("node").distinct()), f"{label}-signs") if signs else None
        rows = still.join(known, "node") if signs else still.withColumn("sign", F.lit(None))
        alike = F.count("*").over(Window.partitionBy("key", "comp"))
        place = Window.partitionBy("key").orderBy(F.desc("alike"), "comp", F.xxhash64("node", F.lit(turn)), "node")
        large, small = rows.filter(f"n > {few}").withColumn("alike", alike), rows.filter(f"n <= {few}")
        others = large.withColumn("k", F.row_number().over(place)).filter(F.col("k") <= HUBS).drop("alike")
        others = others.unionByName(small.withColumn("k", F.lit(0))).select("key", F.col("node").alias("other"), F.col("comp").alias("other_comp"), "k", F.col("sign").alias("other_sign"))
        apart = (F.col("comp") != F.col("other_comp")) & ((F.col("k") > 0) | (F.col("node") < F.col("other")))
        if near:
            apart &= near(F.col("sign"), F.col("other_sign"))
        met = rows.join(others, "key").filter(apart).select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
        roots = _with_links(roots, verify(likely(met).select("a", "b")), label)
        forget(still)
        if signs:
            forget(known)
    nodes = written(_open(shared, roots, few).select("node", "comp").distinct(), f"{label}-open")
    sets = elements(nodes.select("node"))
    if not nodes.isEmpty():
        pairs = prefix_pairs(nodes, sets, least, label, elements)
        roots = _with_links(roots, verify(likely(pairs).select("a", "b")), label)
        forget(pairs)
    forget(nodes)
    return roots


def _open(shared: DataFrame, roots: DataFrame, met: int) -> DataFrame:
    """``key, node, comp, n`` of the buckets that hold several components and more nodes, ``n``, than the ``met``
    of which all pairs have met."""
    known = shared.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("comp"))
    many = known.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("n")).filter(f"lo < hi and n > {met}").select("key", "n")
    return known.join(many, "key")


def _with_links(roots: DataFrame, links: DataFrame, label: str) -> DataFrame:
    """``roots`` after further links; both tables given go."""
    more = written(links, f"{label}-links")
    if more.isEmpty():
        return roots
    new = written(merged(roots, more), f"{label}-roots")
    for old in (roots, more):
        forget(old)
    return new
