"""Line deduplication: equal lines and lines within an edit threshold keep their first occurrence in the corpus.

The threshold grows with the line: one changed character for each 24 characters, one at most, or one changed word for each
ten words, three at most. Candidates come from a segment-partition join: two sequences within k edits share, unchanged, one
of k + 1 segments of the shorter at nearly its place. Each gives hashes of its segments and of the few parts, by length and
place, that could match a segment of a shorter one. Groups of at most GROUP rows are paired. What a larger group shares
says little (boilerplate, a form), so its lines are told apart by their rarest symbols instead (see `_rare`): no group is
paired as a whole and nothing is lost. Candidates are verified by a banded bit-parallel edit distance. Everything is built-in Spark
expressions.

The join runs on distinct lines. A changed character changes two words at most, so the join over characters takes only
lines too short for the join over words to allow that.
"""

from __future__ import annotations

import functools
import itertools
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

GROUP = 64
BLANKS = " \t\n\v\f\r"
ID = "struct<id: bigint, id2: bigint>"


@dataclass(frozen=True)
class Threshold:
    """k edits for a sequence of n symbols: one for each `each`, `most` at most; without `each`, `most` for all that are longer than it."""

    most: int
    each: int | None = None

    def column(self, n: Column) -> Column:
        return F.when(n > self.most, self.most).otherwise(0) if self.each is None else F.least(F.lit(self.most), F.floor(n / self.each).cast("int"))

    def classes(self) -> list[tuple[int, int, int | None]]:
        """(k, least n, n below) of the joins: sequences whose shorter one has threshold k, and those that k edits can reach."""
        if self.each is None:
            return [(self.most, self.most + 1, None)]
        if self.each < 2:
            raise ValueError("a threshold needs two symbols an edit at least")
        return [(k, k * self.each, (k + 1) * self.each + k if k < self.most else None) for k in range(1, self.most + 1)]


def _parts(k: int, d: int) -> list[tuple[int, int, int, int]]:
    """(k, d, segment, offset): where a sequence may hold, moved by offset, the segment of one that is d shorter."""
    return [(k, d, i, off) for i in range(k + 1) for off in range(max(-i, d - (k - i)), min(i, d + k - i) + 1)]


def _table(rows: list[tuple[int, int, int, int]]) -> Column:
    kind = "array<struct<k: int, d: int, i: int, off: int>>"
    return F.array(*[F.struct(*[F.lit(x).alias(c) for x, c in zip(r, ("k", "d", "i", "off"), strict=True)]) for r in rows]).cast(kind) if rows else F.array().cast(kind)


def _size(of: str, words: bool) -> str:
    return f"size({of})" if words else f"char_length({of})"


def _cut(of: str, words: bool) -> str:
    return f"slice({of}, CAST(at AS int) + 1, CAST(len AS int))" if words else f"substring({of}, CAST(at AS int) + 1, CAST(len AS int))"


def _keys(rows: DataFrame, words: bool, table: Column) -> DataFrame:
    """(key, id, role, d, k) of rows with id, seq: role 0 is a segment of the row's own sequence, 1 a part that may match a segment of one that is d shorter."""
    sized = rows.withColumn("n", F.expr(_size("seq", words)))
    each = sized.select("id", "seq", "n", F.explode_outer(table).alias("e")).where("e is not null").select("id", "seq", "n", "e.*").where("n - d > k")
    placed = each.withColumn("at", F.expr("(n - d) * i div (k + 1) + off")).withColumn("len", F.expr("(n - d) * (i + 1) div (k + 1) - (n - d) * i div (k + 1)")).where("at >= 0 and at + len <= n")
    key = F.expr(f"xxhash64(k, n - d, i, {_cut('seq', words)})")
    return placed.select(key.alias("key"), "id", F.expr("IF(d = 0 AND off = 0, 0, 1)").alias("role"), "d", "k")


#: One long counts a key's rows: segments above the low 32 bits, all rows in them.
_COUNT = "sum(IF(role = 0, 4294967297L, 1L)) AS c"


def _live(keys: DataFrame) -> DataFrame:
    """(key, n) of the keys that a segment and another row have."""
    rows = keys.groupBy("key").agg(F.expr(_COUNT)).where("c >= 4294967298 and (c & 4294967295) > 1")
    return common.materialize(rows.select("key", F.expr("c & 4294967295").alias("n")), "livekeys")


def _pairs(rows: DataFrame) -> DataFrame:
    """(a, b) of rows (key, id, role, d) whose groups are small: a segment's line with each that may match it."""
    group = rows.groupBy("key").agg(F.collect_set(F.struct("id", "role", "d")).alias("g")).where((F.size("g") > 1) & F.exists("g", lambda e: e["role"] == 0))
    own = F.filter("g", lambda e: e["role"] == 0)
    pair = lambda x: F.transform(F.filter("g", lambda y: F.when(y["d"] == 0, x["id"] < y["id"]).otherwise(x["id"] != y["id"])), lambda y: F.struct(F.least(x["id"], y["id"]).alias("a"), F.greatest(x["id"], y["id"]).alias("b")))
    return group.select(F.explode_outer(F.flatten(F.transform(own, pair))).alias("p")).where("p is not null").select("p.a", "p.b")


def _links(seqs: DataFrame, symbols: DataFrame, words: bool, threshold: Threshold, group: int, reach: bool) -> DataFrame:
    """(a, b) of ids, a < b, within the threshold, of seqs (id, seq), whose ids are distinct; symbols has (id, seq) as arrays.
    Holds every such pair, or other pairs that lead from one to the other; with reach, those to the least id of a component.

    A group above `group` rows is first compared with its member that stands in most of them. Where its members are then one
    component nothing is left to find; lines of the others meet again by their rarest symbols.
    """
    n = F.expr(_size("seq", words))
    inside = [(k, n >= low if high is None else (n >= low) & (n < high)) for k, low, high in threshold.classes()]

    def keys(wanted) -> DataFrame:
        """The keys of the parts that are wanted."""
        table = F.concat(*[F.when(fits, _table([p for d in range(k + 1) for p in _parts(k, d) if wanted(p)])).otherwise(_table([])) for k, fits in inside])
        return _keys(seqs.select("id", "seq"), words, table)

    segment = lambda p: p[1] == 0 and p[3] == 0
    # one key in six or so is a segment; the others count only where a segment has the same, so few of them are ever written
    own = common.materialize(keys(segment), "linesegments")
    # as the element of an array a key is computed once, apart from the filter; else the compiled method grows too large for the JVM's compiler
    other = keys(lambda p: not segment(p)).select(F.explode(F.array("key")).alias("key"), "id", "role", "d", "k")
    parts = common.materialize(other.where(common.flagged(F.col("key"), own, "key")), "lineparts")
    every = own.union(parts)
    live = _live(every)
    near = common.materialize(every.where(common.flagged(F.col("key"), live, "key")).join(live, "key"), "livelines")
    for done in (own, parts, live):
        common.drop(done)
    del own, other, parts, every, live  # their plans hold bitmaps
    common.tidy(seqs.sparkSession)
    pairs = near.where(F.col("n") <= group).transform(_pairs)
    large = near.where(F.col("n") > group).select("key", "id", "role", "d", "k")
    if large.isEmpty():
        return _near(common.materialize(pairs.distinct(), "linepairs"), symbols, threshold)

    ordered = lambda x, y: (F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    weight = large.groupBy("id").agg(F.count("*").alias("weight"))
    lead = large.where("role = 0").join(weight, "id").groupBy("key").agg(F.max(F.struct("weight", "id")).alias("l")).select("key", F.col("l.id").alias("lead"))
    star = large.join(lead, "key").where("id <> lead").select(*ordered("id", "lead"))
    pairs = common.materialize(pairs.union(star).distinct(), "linepairs")
    links = _near(pairs, symbols, threshold)
    stars = common.connected_components(links)
    place = large.select("key", "id").join(stars.withColumnRenamed("node", "id"), "id", "left").select("key", "id", F.xxhash64(F.coalesce("component", "id")).alias("part"))
    place = common.materialize(place, "hotparts")
    hot = place.groupBy("key").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo <> hi").select("key")
    hot = common.materialize(place.join(hot, "key", "left_semi").select("id", "part").distinct(), "hotids")
    if reach:
        links = stars.where("node <> component").select(F.col("component").alias("a"), F.col("node").alias("b"))
    if hot.isEmpty():
        return links

    more = _rare(symbols.join(hot, "id").select("id", "part", "seq"), threshold, group)
    return links.union(_near(common.materialize(more.join(pairs, ["a", "b"], "left_anti"), "linepairs"), symbols, threshold))


#: Numbers of rare symbols that a key takes, one after the other, for lines in groups that are still large.
TOGETHER = (1, 3, 6)


def _rare(lines: DataFrame, threshold: Threshold, group: int) -> DataFrame:
    """(a, b) of lines (id, part, seq) of different parts that may be within the threshold, found by their rarest symbols.

    Sequences within k edits have all but k symbols in common, each counted as often as it stands there. In any order of
    symbols that is the same for all lines, the first k + c of each then share c at least. Rarest first, these are what sets
    lines with much in common apart. A line has a key for each c of its first k + c symbols; groups of up to `group`
    are paired, and the lines of larger ones go on with the next c, so a line has at most the sum of these binomials in
    keys (108 for three edits), whatever the groups. What is large to the end is joined on the key and on c shared symbols.
    """
    most, classes = threshold.most, threshold.classes()
    steps = TOGETHER if threshold.each is not None and threshold.each > TOGETHER[-1] else (1,)  # a line has `each` symbols an edit, so it has enough of them
    each = lines.select("id", "part", F.size("seq").alias("n"), F.explode("seq").alias("s")).groupBy("id", "part", "n", "s").agg(F.count("*").alias("m"))
    each = common.materialize(each.select("id", "part", "n", "s", F.explode(F.sequence(F.lit(1), F.col("m").cast("int"))).alias("j")), "linetokens")
    often = each.groupBy("s", "j").agg(F.count("*").alias("f"))
    first = F.slice(F.sort_array(F.collect_list(F.struct("f", F.xxhash64("s", "j").alias("t")))), 1, most + steps[-1])
    state = common.materialize(each.join(often, ["s", "j"]).groupBy("id", "part", "n").agg(first.getField("t").alias("rare")), "rarelines")
    found: list[DataFrame] = []
    for c in steps:
        keys = _rare_keys(state, c, classes)
        live = keys.groupBy("key").agg(F.count("*").alias("size"), F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo <> hi").select("key", "size")
        members = common.materialize(keys.join(live, "key"), "raremembers")
        few = members.where(F.col("size") <= group).groupBy("key").agg(F.collect_set(F.struct("id", "part")).alias("g"))
        paired = F.flatten(F.transform("g", lambda x: F.transform(F.filter("g", lambda y: (x["id"] < y["id"]) & (x["part"] != y["part"])), lambda y: F.struct(x["id"].alias("a"), y["id"].alias("b")))))
        found.append(few.select(F.explode(paired).alias("p")).select("p.a", "p.b"))
        many = members.where(F.col("size") > group)
        if many.isEmpty():
            break
        if c == steps[-1]:
            found.append(_rare_pairs(many, c))
        state = many.select("id", "part", "n", "rare").distinct()
    return functools.reduce(lambda x, y: x.union(y), found).distinct()


def _rare_keys(state: DataFrame, c: int, classes: list[tuple[int, int, int | None]]) -> DataFrame:
    """(id, part, n, rare, k, key) of rows (id, part, n, rare): a key for each c of the first k + c symbols, in each class that n is in.

    The places to take come from a table, four bits each and k above them: as expressions of their own, 84 at most, they
    would fill the driver with plans and code.
    """
    packed = lambda k: [sum(i << 4 * j for j, i in enumerate((*at, k))) for at in itertools.combinations(range(k + c), c)]
    inside = [(k, F.col("n") >= low if high is None else (F.col("n") >= low) & (F.col("n") < high)) for k, low, high in classes]
    table = F.concat(*[F.when(fits, F.lit(packed(k))).otherwise(F.array().cast("array<int>")) for k, fits in inside])
    each = state.select("id", "part", "n", "rare", F.explode_outer(table).alias("at")).where("at is not null")
    digit = lambda j: F.shiftright("at", 4 * j).bitwiseAND(F.lit(15))
    key = F.xxhash64(digit(c), F.lit(c), *[F.get("rare", digit(j)) for j in range(c)])
    return each.select("id", "part", "n", "rare", digit(c).alias("k"), key.alias("key"))


def _rare_pairs(many: DataFrame, c: int) -> DataFrame:
    """(a, b) of rows of `_rare_keys` of different parts that share a key and c symbols. Lines with more in common share many keys,
    so only the key of the first c that they share gives the pair; where that key has a small group, the pair was found there."""
    x, y = many.alias("x"), many.alias("y")
    both = F.array_intersect(F.slice("x.rare", 1, F.col("x.k") + c), F.slice("y.rare", 1, F.col("x.k") + c))
    near = (F.abs(F.col("x.n") - F.col("y.n")) <= F.col("x.k")) & (F.size(both) >= c) & (F.col("x.key") == F.xxhash64("x.k", F.lit(c), F.slice(both, 1, c)))
    return x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.id") < F.col("y.id")) & (F.col("x.part") != F.col("y.part")) & near).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))


def banded_distance(a: str, b: str, k: str, most: int, exact: bool = True) -> str:
    """SQL of the edit distance of array columns a and b where it is k <= most at most, else a number above k; if not
    exact, a number of edits of at most k that suffice, where the distance is k at most.

    Equal ends are cut off; then a band of 2 k + 1 cells moves down the diagonal, a column of b a step, as the bits of the
    vertical differences (Myers, 1999; Hyyro, 2003). The number kept is that of the band's lowest cell, and of the last row once
    the band reaches it; when it passes 3 k no cell of the band can lead to k, and steps do nothing. Where one symbol is
    left on a side the distance is known without a walk. So it is where sides of equal size differ at two places at most,
    as a removed and an added symbol that do better leave three.
    """

    def let(value: str, name: str, body: str) -> str:
        return f"get(transform(array({value}), {name} -> {body}), 0)"

    def trimmed(x: str, y: str, r: str, body: str) -> str:
        """body over r.x and r.y: x and y reversed, without what they begin with alike."""
        differ = f"array_position(zip_with({x}, {y}, (x0, y0) -> x0 <=> y0), false)"
        rest = lambda of: f"reverse(slice({of}, p0, greatest(size({of}) - p0 + 1, 0)))"
        first = let(differ, "p1", f"CAST(IF(p1 = 0, size({x}) + 1, p1) AS int)")
        return let(let(first, "p0", f"named_struct('x', {rest(x)}, 'y', {rest(y)})"), r, body)

    pattern, column = "r2.x", "r2.y"

    def walk(q: int) -> str:
        """The walk with a band of q to each side; `get` is null outside the pattern."""
        mask = (1 << (2 * q + 1)) - 1
        match = " + ".join(f"IF(get({pattern}, s.j + {t - q}) = c, {1 << t}L, 0L)" for t in range(2 * q + 1))
        up, down = f"((~(d | s.vp) | s.vn) & {mask}L)", "(d & s.vp)"
        low = f"IF(s.j + {q} < s.n, 1 - CAST(shiftright(d, {2 * q}) & 1L AS int), CAST(shiftright({up}, s.n - s.j + {q - 1}) & 1L AS int) - CAST(shiftright({down}, s.n - s.j + {q - 1}) & 1L AS int))"
        cell = f"named_struct('vp', ({down} | ~(shiftright(d, 1) | {up})) & {mask}L, 'vn', {up} & shiftright(d, 1), 's', s.s + {low}, 'j', s.j + 1, 'n', s.n)"
        step = let(match, "pm", let(f"((((pm & s.vp) + s.vp) ^ s.vp) | pm | s.vn) & {mask}L", "d", cell))
        start = f"named_struct('vp', {mask & ~((1 << q) - 1)}L, 'vn', 0L, 's', least(size({pattern}), {q}), 'j', 0, 'n', size({pattern}))"
        return f"aggregate({column}, {start}, (s, c) -> IF(s.s > {3 * q}, s, {step}), s -> s.s)"

    walks = "CASE q " + " ".join(f"WHEN {q} THEN {walk(q)}" for q in range(1, most + 1)) + " END"
    changed = f"IF(size({pattern}) = size({column}), size(filter(zip_with({pattern}, {column}, (x0, y0) -> x0 <=> y0), e0 -> NOT e0)), q + 1)"
    few = f"least(q, {2 if exact else most})"
    walked = let(changed, "h", f"CASE WHEN h <= {few} THEN h ELSE {walks} END")
    body = f"CASE WHEN size({pattern}) = 0 OR size({column}) = 0 THEN size({pattern}) + size({column}) WHEN q = 0 OR abs(size({pattern}) - size({column})) > q THEN q + 1 WHEN size({pattern}) = 1 OR size({column}) = 1 THEN greatest(size({pattern}), size({column})) - CAST(array_contains({pattern}, get({column}, 0)) OR array_contains({column}, get({pattern}, 0)) AS int) ELSE {walked} END"
    return let(f"CAST({k} AS int)", "q", trimmed(a, b, "r1", trimmed("r1.x", "r1.y", "r2", body)))


def _near(pairs: DataFrame, seqs: DataFrame, threshold: Threshold) -> DataFrame:
    """The pairs (a, b) whose arrays of symbols are within the threshold of the shorter."""
    ends, n = pairs.select(F.explode(F.array("a.id", "b.id")).alias("id")), 2 * pairs.count()
    held = seqs.where(common.flagged(F.col("id.id"), ends, "id", n))
    # the few that a bitmap with room lets through besides find no pair; one that is filling up lets many through
    if n * common.FILTER_EACH > common.FILTER_MOST:
        held = held.join(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "id", "left_semi")
    held = common.materialize(held, "linetexts")
    x, y = held.select(F.col("id").alias("a"), F.col("seq").alias("sa")), held.select(F.col("id").alias("b"), F.col("seq").alias("sb"))
    k = threshold.column(F.least(F.size("sa"), F.size("sb")))
    rows = pairs.join(x, "a").join(y, "b").withColumn("k", k).where(F.abs(F.size("sa") - F.size("sb")) <= F.col("k"))
    # an edit takes one symbol away at most; this spares most pairs the walk, which isn't compiled
    rows = rows.where((F.size(F.array_except("sa", "sb")) <= F.col("k")) & (F.size(F.array_except("sb", "sa")) <= F.col("k")))
    near = common.materialize(rows.where(F.expr(banded_distance("sa", "sb", "k", threshold.most, exact=False)) <= F.col("k")).select("a", "b"), "nearlines")
    common.drop(held)
    del ends, held, x, y, rows
    common.tidy(seqs.sparkSession)
    return near


def sequence_links(seqs: DataFrame, words: bool, threshold: Threshold, group: int = GROUP, reach: bool = False) -> DataFrame:
    """(a, b) of ids of sequences within the threshold, a < b; seqs has id, a struct of two longs, and seq: an array of
    integers if words, else a string, whose symbols are its characters. Ids are distinct.

    Of groups of many that are near one another, pairs with one member or a chain are returned in place of all pairs: they
    reach one another, no link is lost. With reach, links found first may come as stars, not all of whose pairs are within
    the threshold: they lead as far and leave fewer rounds to connected components.
    """
    with common.scratch(seqs.sparkSession) as keep:
        symbols = seqs if words else seqs.select("id", F.transform(F.split("seq", ""), lambda c: F.hash(c)).alias("seq"))
        links = common.materialize(_links(seqs, symbols, words, threshold, group, reach), "linelinks")
        keep.append(links)
    return links


def edit_links(lines: DataFrame, k: int = 1, group: int = GROUP) -> DataFrame:
    """(a, b) of ids of different lines longer than k characters that are within k edits; lines has id, line, where equal ids have equal lines and may repeat."""
    seqs = lines.select(F.struct(F.col("id").cast("long").alias("id"), F.xxhash64("line").alias("id2")).alias("id"), F.col("line").alias("seq")).distinct()
    return sequence_links(seqs, False, Threshold(k), group).select("a.id", F.col("b.id").alias("other")).toDF("a", "b")


def word_links(lines: DataFrame, most: int = 3, each: int = 10, group: int = GROUP) -> DataFrame:
    """(a, b) of ids of different lines within w changed, added or removed words (between blanks), where w is one for each
    `each` words of the line with fewer words, `most` at most; lines as in edit_links."""
    seqs = lines.select(F.struct(F.col("id").cast("long").alias("id"), F.xxhash64("line").alias("id2")).alias("id"), _word_codes(F.split("line", " ")).alias("seq")).distinct()
    return sequence_links(seqs, True, Threshold(most, each), group).select("a.id", F.col("b.id").alias("other")).toDF("a", "b")


def _word_codes(words: Column) -> Column:
    """A 32-bit hash for each word; two words share one with a chance of 2^-32, which can only lower a distance."""
    return F.transform(words, lambda w: F.hash(w))


def dedup_lines(docs: DataFrame, k: int = 1, each_chars: int = 24, changed: int = 3, each_words: int = 10) -> DataFrame:
    """docs with repeated lines removed from `text`, and n_lines, n_removed, n_left (lines with a word left), all long.

    Lines are what \\n separates. Each line with a word in it belongs to a class: lines equal to it, within one edit for each
    `each_chars` characters (k at most), or within one changed word for each `each_words` words (`changed` at most), by the
    shorter of the two, directly or through others. Of a class only the first occurrence stays, by doc_id, then a hash of the
    text, then place; lines without a word stay as they are. Lines are known by 128-bit hashes. Texts move once, joined with
    the places to remove.
    Null text: stays null, no lines. Null doc_id: sorts before others. Rows equal in doc_id and text keep or lose the same
    lines. No rows: no rows. Other columns stay, whatever their names; one named n_lines, n_removed or n_left is a ValueError.
    """
    taken = {c.lower() for c in docs.columns} & {"n_lines", "n_removed", "n_left"}
    if taken:
        raise ValueError(f"docs already has the columns {sorted(taken)}")
    rows, row = _without_repeats(docs, k, each_chars, changed, each_words)
    # as the element of an array it is computed once; what is removed has a word
    rows = rows.select(row, "text0", "lost", "new", F.explode(F.array(F.split("text0", "\n"))).alias("all0"))
    n_lines, n_removed = (F.when(F.col(c).isNull(), 0).otherwise(F.size(of)).cast("long") for c, of in (("text0", "all0"), ("lost", "lost")))
    counts = [n_lines.alias("n_lines"), n_removed.alias("n_removed"), (_worded(F.col("text0"), F.col("all0")) - n_removed).alias("n_left")]
    return rows.select(*[F.col("new").alias(c) if c == "text" else F.col(f"{row}.`{c}`") for c in docs.columns], *counts)


def drop_repeated_lines(docs: DataFrame, k: int = 1, each_chars: int = 24, changed: int = 3, each_words: int = 10) -> DataFrame:
    """docs, with its columns, after `dedup_lines`: documents that lose every line with a word go, and n_chars, where there is one, is that of the new text. A null text stays."""
    rows, row = _without_repeats(docs, k, each_chars, changed, each_words)
    own = {"text": F.col("new"), "n_chars": F.length("new").cast("long")}
    return rows.where(F.col("lost").isNull() | _has_word(F.col("new"))).select(*[own.get(c, F.col(f"{row}.`{c}`")).alias(c) for c in docs.columns])


def _has_word(text: Column) -> Column:
    """Whether a text holds more than blanks. Ends at the first that is none; a pattern would have the whole text decoded first."""
    return F.ltrim(text, F.lit(BLANKS)) != ""


def _worded(text: Column, lines: Column | None = None) -> Column:
    """The number of lines with a word of a text; 0 for null. lines: the text's, where they are at hand."""
    return F.when(text.isNull(), 0).otherwise(F.size(F.filter(F.split(text, "\n") if lines is None else lines, _has_word))).cast("long")


def _without_repeats(docs: DataFrame, k: int, each_chars: int, changed: int, each_words: int) -> tuple[DataFrame, str]:
    """A struct of docs' columns, `text0` (text), `lost` (places of removed lines, null where there are none) and `new` (text); the struct's name."""
    text = F.col("text").cast("string")
    base = docs.select(F.col("doc_id").cast("long").alias("doc"), F.xxhash64(text).alias("tag"), text.alias("text")).where("text is not null")
    with common.scratch(docs.sparkSession) as keep:
        known, lines = _classes(base, k, each_chars, changed, each_words)
        # lines that stand once and are near no other need no shuffle
        lost = lines.select("id", "place").where(common.flagged(F.col("id.id"), known.select("id.id"), "id")).join(known, "id").where("place <> keep").select("place.*")
        lost = common.materialize(lost.groupBy("doc", "tag").agg(F.collect_set("pos").alias("lost")), "lostlines")
        keep.append(lost)
    held = f"row_{uuid.uuid4().hex}"
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(held), F.col("doc_id").cast("long").alias("doc0"), F.xxhash64(text).alias("tag0"), text.alias("text0"))
    # texts that lose nothing need no shuffle
    touched = common.flagged(F.col("tag0"), lost, "tag")
    found = rows.where(touched).join(lost, F.col("doc0").eqNullSafe(F.col("doc")) & (F.col("tag0") == F.col("tag")), "left").withColumn("parts", F.split("text0", "\n"))
    left = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), F.col("lost"))
    new = F.when(F.col("lost").isNull(), F.col("text0")).otherwise(F.array_join(F.transform(left, lambda i: F.get("parts", i)), "\n"))
    # as the element of an array it is computed once
    found = found.select(held, "text0", "lost", F.explode(F.array(new)).alias("new"))
    whole = rows.where(~touched).select(held, "text0", F.lit(None).cast("array<int>").alias("lost"), F.col("text0").alias("new"))
    return found.union(whole), held


def _classes(base: DataFrame, k: int, each_chars: int, changed: int, each_words: int) -> tuple[DataFrame, DataFrame]:
    """(id, keep) of the lines that lose occurrences, and every line's occurrence with its id and place."""
    each = base.select("doc", "tag", F.posexplode_outer(F.split("text", "\n")).alias("pos", "line")).where(_has_word(F.col("line")))
    identity = F.struct(F.xxhash64("line").alias("id"), F.xxhash64(F.lit(20240611), "line").alias("id2")).alias("id")
    # as the element of an array it is computed once
    each = each.select("doc", "tag", "pos", "line", F.explode(F.array(_word_codes(F.split("line", " ")))).alias("words"))
    size = F.size("words")
    # a changed character is two changed words at most, so the join over words finds it where it allows 2 k of them
    short = F.lit(True) if changed < 2 * k else size < 2 * k * each_words + k
    lines = each.select(
        identity,
        F.struct("doc", "tag", "pos").alias("place"),
        F.when(short & (F.length("line") >= each_chars), F.col("line")).alias("chars"),
        F.when(size >= each_words, F.col("words")).alias("codes"),
    )
    lines = common.materialize(lines, "lines")
    twice = common.materialize(lines.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id.id"), "twicelines")
    # lines that stand once need no shuffle to be distinct, and no first place
    many = common.flagged(F.col("id.id"), twice, "id")
    wanted = lines.where("chars is not null or codes is not null").select("id", "chars", "codes")
    repeated = common.materialize(wanted.where(many).dropDuplicates(["id"]), "repeatedlines")
    distinct = wanted.where(~many).union(repeated)
    links = None
    for column, words, threshold in (("chars", False, Threshold(k, each_chars)), ("codes", True, Threshold(changed, each_words))):
        if threshold.most:
            own = sequence_links(distinct.where(F.col(column).isNotNull()).select("id", F.col(column).alias("seq")), words, threshold, reach=True)
            links = own if links is None else links.union(own)
    first = lambda of: lines.where(of).groupBy("id").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    if links is None:
        known = first(many).where("n > 1").select("id", F.col("first").alias("keep"))
    else:
        classes = common.connected_components(links).withColumnRenamed("node", "id")
        some = common.materialize(first(many | common.flagged(F.col("id.id"), classes.select("id.id"), "id")), "classlines")
        # a line that is near none is a class of its own, so that no null is a key
        some = some.join(classes, "id", "left").select("id", "first", "n", F.coalesce("component", "id").alias("class"))
        lead = some.groupBy("class").agg(F.min("first").alias("keep"))
        known = some.join(lead, "class").where("n > 1 or keep <> first").select("id", "keep")
    return common.materialize(known, "lineclasses"), lines
