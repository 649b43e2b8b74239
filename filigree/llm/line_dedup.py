"""Fuzzy line duplicates: SimHash, pigeonhole blocks, edit similarity, one occurrence for each group.

DataFrame functions only. A line is normalised to its words (letters and digits, lower case) in their
order with repeats. The fingerprint's bit is set if more than half of the distinct words' hashes have
it: words are listed row by row, and the 64 counts of a line are summed in lanes packed into longs,
before anything is shuffled. Two normalised lines are linked if their fingerprints differ in at
most two bits and their edit similarity, ``1 - levenshtein / longer length``, is 0.8 or more.

Fingerprints within two bits agree on two of four 16-bit blocks, so six keys bring them together.
Keys of more than ``PAIR_LIMIT`` fingerprints are not paired: such fingerprints meet at the values
within one bit of them, at each of which no more than 65 can meet. Neither path loses a link.

Texts of one fingerprint are compared with the group's pivot, its smallest digest, and pivots of close
fingerprints with each other. Only texts that are not linked to their pivot, or whose pivots are not
linked, are compared with the others, and only with those whose length allows a link. A large group of
near copies is thus compared once a text, not once a pair, and no link is lost: leaving out pairs that
the pivot joins already cannot part a group. Texts whose fingerprint meets no other, most of them, take no
part in these steps. Text does not travel with the fingerprints; it is fetched
again for the lines of candidate pairs only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filigree.llm.common import free_names, stage
from filigree.llm.components import connected_components
from filigree.operators.joins import broadcast_up_to

MAX_BITS, SIMILARITY, PAIR_LIMIT = 2, 0.8, 32
# Lanes by number of words: up to how many the top lane, which holds the sign, can count; bits of a lane.
LANES = ((2047, 13), (2**31 - 1, 32))
TOGETHER = 8  # words of a line that are added up before they are summed by line
LISTED_BYTES = 32 << 20  # lists of ids or keys up to this size pick rows before these are shuffled


def normal(line: Column) -> Column:
    """The words of a line in their order, repeats included, parted by single blanks."""
    low = F.lower(line)
    plain = F.regexp_replace(low, "[^a-z0-9]+", " ")  # the same for texts of ASCII only, and faster
    return F.trim(F.when(F.octet_length(low) == F.length(low), plain).otherwise(F.regexp_replace(low, "[^\\p{L}\\p{N}]+", " ")))


def lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc, line_no, line)`` for every line of every row; a null text is one empty line."""
    cut = F.split(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "\n", -1)
    return docs.select(F.col(id_col).alias("doc"), F.posexplode(cut).alias("line_no", "line"))


def _majority(width: int, counters: list[Column]) -> Column:
    """The fingerprint from counters with lanes of ``width``: a bit is set if more than half of the ``n`` hashes have it.

    A lane gets what it lacks to reach its highest bit at a count of ``n / 2 + 1``, all lanes of a
    counter in one addition. The top lane is added apart, since it has no room above.
    """
    top = width * (63 // width)
    places = sum(1 << b for b in range(0, top, width))
    lack = F.lit((1 << (width - 1)) - 1).cast("bigint") - F.shiftright(F.col("n").cast("bigint"), 1)

    def part(j: int) -> Column:
        counter = counters[j]
        low = F.shiftrightunsigned(counter.bitwiseAND(F.lit((1 << top) - 1)) + lack * F.lit(places), width - 1).bitwiseAND(F.lit(places))
        high = F.shiftrightunsigned(F.shiftrightunsigned(counter, top) + lack, width - 1).bitwiseAND(F.lit(1).cast("bigint"))
        return F.shiftleft(low.bitwiseOR(F.shiftleft(high, top)), j)

    return reduce(lambda x, y: x.bitwiseOR(y), [part(j) for j in range(width)])


def _lane(name: str, j: int, width: int) -> Column:
    """Bits ``j``, ``j + width``, ... of the hash ``name``, each in a lane of its own."""
    return F.shiftrightunsigned(name, j).bitwiseAND(F.lit(sum(1 << b for b in range(0, 64, width))))


def _folded(width: int) -> Column:
    """The fingerprint of a line of many words, whose hashes ``hs`` are summed inside the row."""
    zero, spread = F.lit(0).cast("bigint"), sum(1 << b for b in range(0, 64, width))

    def one(j: int) -> Column:
        return F.aggregate("hs", zero, lambda total, h: total + F.shiftrightunsigned(h, j).bitwiseAND(F.lit(spread)))

    return _majority(width, [one(j) for j in range(width)])


def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc, line_no, digest, size, fp)``, ``size`` in characters; the last three null for lines without words.

    Words of lines of up to ``LANES[0]`` words are listed as rows of ``TOGETHER`` words and summed by line; the
    sums of a line are complete in the task that reads it, and one row a line is shuffled. The digest is hex
    there, since Spark's fast map of sums takes no binary keys.
    """
    named = lines(docs, id_col, text_col).select("doc", "line_no", normal(F.col("line")).alias("text"), F.monotonically_increasing_id().alias("at"))
    worded = F.length("text") > 0
    split = F.when(worded, F.array_distinct(F.split("text", " ")))
    listed = named.select("at", "doc", "line_no", F.when(worded, F.md5("text")).alias("digest"), F.length("text").alias("size"), split.alias("w"))
    counted = listed.withColumn("n", F.coalesce(F.size("w"), F.lit(0)))
    (few, narrow), *wide = LANES
    hashes = counted.withColumn("hs", F.when(F.col("n") > few, F.transform("w", lambda x: F.xxhash64(x))))
    long, above = F.lit(None).cast("bigint"), few
    for most, width in wide:
        long, above = F.when(F.col("n").between(above + 1, most), _folded(width)).otherwise(long), most
    keys = ["at", "doc", "line_no", "digest", "size", "n", "long"]
    firsts = F.sequence(F.lit(0), F.greatest(F.col("n") - 1, F.lit(0)), F.lit(TOGETHER))
    pieces = hashes.select(*keys[:-1], long.alias("long"), "w", F.explode_outer(F.when(F.col("n") <= few, firsts)).alias("from"))
    hash_of = lambda at: F.when(at < F.col("n"), F.xxhash64(F.get("w", at))).otherwise(F.lit(0).cast("bigint"))
    rows = pieces.select(*keys, *[hash_of(F.col("from") + k).alias(f"h{k}") for k in range(TOGETHER)])
    lanes = [reduce(lambda x, y: x + y, [_lane(f"h{k}", j, narrow) for k in range(TOGETHER)]) for j in range(narrow)]
    summed = rows.groupBy(*keys).agg(*[F.sum(lane).alias(f"c{j}") for j, lane in enumerate(lanes)])
    short = F.when(F.col("n").between(1, few), _majority(narrow, [F.col(f"c{j}") for j in range(narrow)]))
    return summed.select("doc", "line_no", F.unhex("digest").alias("digest"), F.when(F.col("n") > 0, F.col("size")).alias("size"), F.coalesce("long", short).alias("fp"))


def _close(fps: str) -> Column:
    """Pairs of a short list of fingerprints that differ in at most ``MAX_BITS`` bits."""
    return F.expr(f"""flatten(transform({fps}, x -> transform(
        filter({fps}, y -> y > x and bit_count(x ^ y) <= {MAX_BITS}), y -> named_struct('a', x, 'b', y))))""")


def close_fingerprints(prints: DataFrame, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """All pairs ``(a, b)``, ``a < b``, of distinct ``prints(fp)`` within two bits."""
    blocks = [F.shiftrightunsigned("fp", 16 * k).bitwiseAND(F.lit(0xFFFF)) for k in range(4)]
    keys = [F.shiftleft(blocks[i], 16).bitwiseOR(blocks[j]).bitwiseOR(F.lit((4 * i + j) << 32)) for i in range(4) for j in range(i + 1, 4)]
    keyed = prints.select("fp", F.explode(F.array(*keys)).alias("key"))
    sizes = stage(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    members = keyed.join(broadcast_up_to(sizes, LISTED_BYTES), "key")  # few keys are shared
    small = members.where(F.col("n") <= pair_limit).groupBy("key").agg(F.collect_list("fp").alias("fps"))
    hot = members.where(F.col("n") > pair_limit).select("fp").distinct()
    flips = F.expr("concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i)))")
    met = hot.select("fp", F.explode(flips).alias("middle")).groupBy("middle").agg(F.collect_list("fp").alias("fps")).where("size(fps) > 1")
    both = small.select("fps").unionByName(met.select("fps"))
    return both.select(F.explode(_close("fps")).alias("p")).select("p.a", "p.b").distinct()


def _texts(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(digest, text)`` of the normalised lines at ``wanted(doc, line_no, digest)``."""
    per_doc = stage(wanted.groupBy("doc").agg(F.collect_list(F.struct("line_no", "digest")).alias("at")))
    ids = broadcast_up_to(per_doc.select(F.col("doc").alias("_doc")), LISTED_BYTES)
    own = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    own = own.join(ids, F.col("_id").eqNullSafe(F.col("_doc")), "left_semi")  # texts without such a line are not shuffled
    found = own.join(per_doc, own["_id"].eqNullSafe(per_doc["doc"])).select(F.split(F.coalesce("_text", F.lit("")), "\n", -1).alias("cut"), F.explode("at").alias("at"))
    picked = found.select(F.col("at.digest").alias("digest"), normal(F.get("cut", F.col("at.line_no"))).alias("text"))
    return picked.where(F.unhex(F.md5("text")) == F.col("digest")).dropDuplicates(["digest"])


def similar(s: str, t: str) -> Column:
    """True if the normalised texts ``s`` and ``t`` have an edit similarity of ``SIMILARITY`` or more.

    Words that both begin or end with do not count for the distance, so that only what lies between
    is compared; if that is no longer than the edits allowed, nothing is left to find out. Texts of as many
    words are similar also if the words that differ place by place are no longer together than the edits allowed.
    """
    allowed = f"cast(floor(greatest(length({s}), length({t})) * {1 - SIMILARITY} + 1e-9) as int)"
    bound = lambda value, name, body: f"get(transform(array({value}), {name} -> {body}), 0)"
    agreeing = lambda a, b: bound(f"array_position(zip_with({a}, {b}, (x, y) -> x <=> y), false)", "at", f"cast(if(at = 0, least(size({a}), size({b})), at - 1) as int)")
    rest = lambda a, k: f"slice({a}, {k} + 1, size({a}) - {k})"
    joined = lambda a: f"concat_ws('', transform({a}, x -> concat(x, ' ')))"
    inner = f"greatest(length(m.x), length(m.y)) <= {allowed} or levenshtein(m.x, m.y, {allowed}) >= 0"
    left = lambda a: joined(f"reverse({rest(a, 'q')})")
    middle = bound(f"struct({left('r.x')} as x, {left('r.y')} as y)", "m", inner)
    ends = bound(f"struct(reverse({rest('w.x', 'p')}) as x, reverse({rest('w.y', 'p')}) as y)", "r", bound(agreeing("r.x", "r.y"), "q", middle))
    replaced = "aggregate(zip_with(w.x, w.y, (x, y) -> if(x = y, 0, greatest(length(x), length(y)))), 0, (total, n) -> total + n)"
    words = f"(size(w.x) = size(w.y) and {replaced} <= {allowed}) or {bound(agreeing('w.x', 'w.y'), 'p', ends)}"
    whole = bound(f"struct(split({s}, ' ') as x, split({t}, ' ') as y)", "w", words)
    return F.expr(f"abs(length({s}) - length({t})) <= {allowed} and {whole}")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``(x, y)`` of digests whose texts are similar; dealt out by hash, since comparing costs more than reading."""
    joined = pairs.join(texts.select(F.col("digest").alias("x"), F.col("text").alias("s")), "x").join(texts.select(F.col("digest").alias("y"), F.col("text").alias("t")), "y")
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return joined.repartition(parts, "x", "y").where(similar("s", "t")).select("x", "y")


def _meeting(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pairs of close fingerprints, and the nodes that share their fingerprint or have a close one: no other has a link."""
    prints = stage(nodes.groupBy("fp").agg(F.count("*").alias("n")))
    pairs = stage(close_fingerprints(prints.select("fp")))
    met = prints.where("n > 1").select("fp").unionByName(pairs.select(F.explode(F.array("a", "b")).alias("fp"))).distinct()
    return pairs, stage(nodes.join(met, "fp", "left_semi"))


def _links(nodes: DataFrame, pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Links ``(x, y)`` that connect exactly the groups of ``nodes(digest, fp, size, first)``, whose close fingerprints are ``pairs``."""
    pivots = stage(nodes.groupBy("fp").agg(F.min_by(F.struct("digest", "first"), "digest").alias("pivot"), F.count("*").alias("n")))
    many = nodes.join(pivots.where("n > 1"), "fp")
    spokes = many.where(F.col("digest") != F.col("pivot.digest")).select(F.col("pivot").alias("p"), F.struct("digest", "first").alias("q"))
    side = lambda name: pivots.select(F.col("fp").alias(name), F.col("pivot").alias(f"p_{name}"), F.col("n").alias(f"n_{name}"))
    close = stage(pairs.join(side("a"), "a").join(side("b"), "b"))
    first = stage(spokes.unionByName(close.select(F.col("p_a").alias("p"), F.col("p_b").alias("q"))))
    wanted = first.select(F.explode(F.array("p", "q")).alias("e")).distinct()
    texts = stage(_texts(docs, wanted.select("e.first.doc", "e.first.line_no", "e.digest"), id_col, text_col))
    found = stage(_verified(first.select(F.col("p.digest").alias("x"), F.col("q.digest").alias("y")), texts))
    # What the pivots leave open: members of a block of texts that its main group does not hold.
    tied = found.select(F.col("x").alias("_x"), F.col("y").alias("_y"))
    own = many.join(tied, (F.col("pivot.digest") == F.col("_x")) & (F.col("digest") == F.col("_y")), "left")
    alone = nodes.join(pivots.where("n = 1"), "fp").select("fp", "digest", "size", F.lit(True).alias("main"))
    held = own.select("fp", "digest", "size", (F.col("_x").isNotNull() | (F.col("digest") == F.col("pivot.digest"))).alias("main"))
    members = stage(held)
    wide = close.where("n_a > 1 or n_b > 1").join(tied, (F.col("p_a.digest") == F.col("_x")) & (F.col("p_b.digest") == F.col("_y")), "left").select("a", "b", F.col("_x").isNotNull().alias("met"))
    texts_of = members.unionByName(alone.join(wide.select(F.explode(F.array("a", "b")).alias("fp")).distinct(), "fp", "left_semi"))
    block = lambda a, b: F.struct(F.col(a).alias("a"), F.col(b).alias("b")).alias("block")
    left = wide.join(texts_of, wide.a == texts_of.fp).select(block("a", "b"), F.lit(0).alias("side"), "digest", "size", "main")
    right = wide.join(texts_of, wide.b == texts_of.fp).select(block("a", "b"), F.lit(1).alias("side"), "digest", "size", (F.col("main") & F.col("met")).alias("main"))
    same = members.join(pivots.where("n > 2").select("fp"), "fp", "left_semi").select(block("fp", "fp"), F.lit(2).alias("side"), "digest", "size", "main")
    all_ = left.unionByName(right).unionByName(same).withColumn("band", F.floor(F.log(F.col("size").cast("double")) / F.log(F.lit(1 / SIMILARITY))))
    rest = all_.where(~F.col("main")).select("block", F.col("side").alias("_side"), F.col("digest").alias("x"), F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"))
    met = rest.join(all_.withColumnRenamed("digest", "y"), ["block", "band"]).where("x <> y and (side = 2 or side <> _side)")
    open_ = met.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
    return found.unionByName(_verified(open_, texts))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc, line_no, digest, kept)`` for every line; of a group the first occurrence is kept.

    First means the smallest id, then the smallest line number; a null id comes first. Lines without
    words are always kept.
    """
    seen = stage(occurrences(docs, id_col, text_col))
    worded = seen.where("digest is not null")
    nodes = stage(worded.groupBy("digest", "fp", "size").agg(F.min(F.struct("doc", "line_no")).alias("first")))
    pairs, meeting = _meeting(nodes)
    near = stage(_links(meeting, pairs, docs, id_col, text_col))
    found = stage(connected_components(near.select(F.col("x").alias("a"), F.col("y").alias("b"))))
    # The first line of a group is the first of its text, so a text either keeps its first line or none.
    linked = stage(meeting.join(found, meeting.digest == found.node).select("digest", "first", "component"))
    heads = linked.groupBy("component").agg(F.min("first").alias("head"))
    lost = linked.join(heads, "component").where(~F.col("first").eqNullSafe(F.col("head"))).select("digest")
    firsts = nodes.join(lost, "digest", "left_anti").select("digest", "first")
    out = worded.join(firsts, "digest", "left").select("doc", "line_no", "digest", F.struct("doc", "line_no").eqNullSafe(F.col("first")).alias("kept"))
    return out.unionByName(seen.where("digest is null").select("doc", "line_no", "digest", F.lit(True).alias("kept")))


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_lines, n_dropped, dropped)`` for every id; ``dropped`` lists line numbers from 0.

    Null and empty texts have one line without words. Rows that repeat an id count as one document.
    An empty table gives an empty result; other columns are not read.
    """
    dropped = F.array_sort(F.collect_list(F.when(~F.col("kept"), F.col("line_no"))))
    out = groups(docs, id_col, text_col).groupBy("doc").agg(F.count("*").alias("n_lines"), F.sum((~F.col("kept")).cast("long")).alias("n_dropped"), dropped.alias("dropped"))
    return out.withColumnRenamed("doc", id_col)


def drop_fuzzy_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the dropped lines taken out of the texts, all columns kept; a null text stays null."""
    name, dropped = free_names(docs, "id", "dropped")
    report = line_report(docs, id_col, text_col).select(F.col(id_col).alias(name), F.col("dropped").alias(dropped))
    joined = docs.join(report, F.col(id_col).eqNullSafe(F.col(name)), "left")
    rest = F.filter(F.split(F.col(text_col), "\n", -1), lambda _, i: ~F.array_contains(dropped, i))
    return joined.withColumn(text_col, F.array_join(rest, "\n")).select(docs.columns)
