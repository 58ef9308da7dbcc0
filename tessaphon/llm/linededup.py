"""Near-duplicate lines by a segment-partition edit join.

Two lines are near if their edit distance (code points) is at most 2.  A line
is cut into threshold + 1 segments; of two near lines, one has a segment of
the other unchanged, at one of few places that the lengths allow.  So each line
is indexed by its segments, keyed by length, number and text, and probes, for
its own length and the lengths up to the threshold below it, with the substrings
that the multi-match-aware rule admits: 3 keys of its own and 9 others.

Keys are first aggregated to (key, smallest line, largest line), which drops
those of one line, however often it occurs; lines meet only on the rest.  Lines that
share a frequent key are compared with one representative of the key, and then
with those that differ from it between the same places (see ``late``).
Candidates are verified by a banded bit-parallel automaton: one bit for each
diagonal within the threshold, one word for each number of errors.

A line goes if it is near, or equal, to a line that occurs first (by document
id and line number) at an earlier place.  Lines shorter than 20 code points
have no part in the edit join.  With ``short``, those of them that aren't blank
go if they equal an earlier line; without it, they stay.  All of it is
DataFrame functions.

Defined cases: a null or empty text stays as it is; a document with a null id
has no part in this and stays; rows of one id and text are one document; the
first line of a text counts like any other, so a text may become empty; an
empty table gives an empty result; other columns stay, whatever they are called.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, forget, join_checked

THRESHOLD, LEAST_CHARS = 2, 20
#: Lines of a key beyond which they are compared with a representative; steps from key to line to the earliest.
FREQUENT, STEPS = 24, 3
#: Characters of a text that meets on patterns; of a first part that tells most lines apart; what marks an open place.
SHORT, FIRST_PART, OPEN = 8, 16, "\U0010ffff"
#: What a line has that isn't blank.
_SEEN = "[^\\s\\p{Z}]"


PARTS = THRESHOLD + 1


def _measured(rows: DataFrame, text: str) -> DataFrame:
    """With what the keys are made of, once for each row: for each length, the size of a segment and how many are longer by one."""
    sized = rows.withColumn("_n0", F.char_length(text))
    for delta in range(1, PARTS):
        sized = sized.withColumn(f"_n{delta}", F.col("_n0") - delta)
    return sized.select("*", *(F.expr(f"CAST(_n{d} DIV {PARTS} AS INT)").alias(f"_b{d}") for d in range(PARTS)), *(F.expr(f"_n{d} % {PARTS}").alias(f"_m{d}") for d in range(PARTS)))


def _segment(delta: int, i: int):
    """Start (from 1) and size of segment i (from 1) of a text of a length: even, the longer ones last."""
    base, short = F.col(f"_b{delta}"), F.lit(PARTS) - F.col(f"_m{delta}")
    start = base * (i - 1) + 1
    return (start if i == 1 else start + F.greatest(F.lit(i - 1) - short, F.lit(0))), base + F.when(short < i, 1).otherwise(0)


def _keys():
    """(length, number, start, size) of a measured text's own segments, then of those that it probes with."""
    own, probes = [], []
    for delta in range(PARTS):
        for i in range(1, PARTS + 1):
            start, size = _segment(delta, i)
            low = max(-(i - 1), delta - (PARTS - i))
            high = min(i - 1, delta + (PARTS - i))
            for shift in range(low, high + 1):
                (own if delta == 0 and shift == 0 else probes).append((F.col(f"_n{delta}"), i, start + shift if shift else start, size))
    return own, probes


def lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, th (hash of the text), no, line, size, h1, h2 for every line."""
    base = docs.filter(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("t"))
    split = base.select("doc", F.xxhash64("t").alias("th"), F.posexplode(F.split("t", "\n")).alias("no", "line"))
    return split.select("doc", "th", "no", "line", F.char_length("line").alias("size"), F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))


def _posted(rows: DataFrame, text: str, *kept, parent: str | None = None) -> DataFrame:
    """kept, key, k (its number) and indexed (whether it is of an own segment)."""
    own, probes = _keys()
    more = [] if parent is None else [F.col(parent)]
    each = [F.xxhash64(*more, of, F.lit(i), F.substring(text, start, size)) for of, i, start, size in (*own, *probes)]
    out = _measured(rows, text).select(*kept, F.posexplode(F.array(*each)).alias("k", "key"))
    return out.select(*kept, "key", "k", (F.col("k") < len(own)).alias("indexed"))


def _without(rows: DataFrame) -> DataFrame:
    """With rest: the text without what its key number k stands for."""
    own, probes = _keys()
    left = F.lit(None).cast("string")
    for k, (_, _, start, size) in enumerate((*own, *probes)):
        left = F.when(F.col("k") == k, F.concat(F.substring("text", F.lit(1), start - 1), F.substring("text", start + size, F.col("_n0")))).otherwise(left)
    return _measured(rows, "text").withColumn("rest", left)


def _let(value, body):
    """body of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _common(a, b):
    """Length of the common prefix of two texts, by halved steps."""
    top = F.floor(F.log2(F.greatest(F.least(F.char_length(a), F.char_length(b)), F.lit(1)))).cast("int")
    steps = F.transform(F.sequence(top, F.lit(0), F.lit(-1)), lambda k: F.call_function("shiftleft", F.lit(1), k))

    def step(n, size):
        piece = F.substring(a, n + 1, size)
        return F.when((F.char_length(piece) == size) & (piece == F.substring(b, n + 1, size)), n + size).otherwise(n)

    return F.aggregate(steps, F.lit(0), step)


def _stripped(a, b, body):
    """body of the lengths of the common prefix and of the common suffix of what that leaves."""
    suffix = lambda p: F.least(_common(F.reverse(a), F.reverse(b)), F.char_length(a) - p, F.char_length(b) - p)
    return _let(_common(a, b), lambda p: _let(suffix(p), lambda s: body(p, s)))


def _middle(text, p, s):
    return F.substring(text, p + 1, F.char_length(text) - p - s)


def _automaton(a, b):
    """The automaton's last state for two texts: words r0, r1 and so on."""
    pad, width = b"\xff\xff\xff\xff" * THRESHOLD, 2 * THRESHOLD + 1
    first = F.encode(a, "UTF-32")
    second = F.concat(F.lit(pad), F.encode(b, "UTF-32"), F.lit(pad))
    full = (1 << width) - 1

    def step(state, j):
        char = F.substring(state["a"], j * 4 + 1, F.lit(4))
        same = reduce(lambda x, y: x.bitwiseOR(y), [F.when(F.substring(state["b"], (j + k) * 4 + 1, F.lit(4)) == char, 1 << k).otherwise(0) for k in range(width)])
        return F.when(state[f"r{THRESHOLD}"] == 0, state).otherwise(advance(state, same))

    def advance(state, same):
        # Bit k: diagonal k - threshold.  A match or a replacement stays on it, an
        # insertion goes down one, a deletion (before the next character) up one.
        out = [state["r0"].bitwiseAND(same)]
        for d in range(1, THRESHOLD + 1):
            old, less = state[f"r{d}"], state[f"r{d - 1}"]
            r = old.bitwiseAND(same).bitwiseOR(less).bitwiseOR(F.shiftright(less, 1)).bitwiseOR(F.shiftleft(out[-1], 1))
            out.append(r.bitwiseAND(F.lit(full)))
        return F.struct(state["a"].alias("a"), state["b"].alias("b"), *(r.alias(f"r{d}") for d, r in enumerate(out)))

    start = [F.lit(sum(1 << (THRESHOLD + k) for k in range(d + 1))) for d in range(THRESHOLD + 1)]
    state = F.struct(first.alias("a"), second.alias("b"), *(r.alias(f"r{d}") for d, r in enumerate(start)))
    places = F.when(F.char_length(a) > 0, F.sequence(F.lit(0), F.char_length(a) - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(places, state, step)[f"r{THRESHOLD}"]


def near(a, b):
    """Whether the edit distance of two lines is at most the threshold (columns to column).

    Common ends are cut off before the automaton runs; a first part, with what
    the other line may have in its place, tells most lines that aren't near.
    """

    def ends(t):
        diagonal = F.char_length(t["b"]) - F.char_length(t["a"]) + THRESHOLD
        reached = F.call_function("shiftright", _automaton(t["a"], t["b"]), diagonal.cast("int")).bitwiseAND(F.lit(1)) == 1
        begun = _automaton(F.substring(t["a"], 1, FIRST_PART), F.substring(t["b"], 1, FIRST_PART + THRESHOLD)) > 0
        tiny = F.greatest(F.char_length(t["a"]), F.char_length(t["b"])) <= THRESHOLD
        return F.when(tiny, True).when((F.char_length(t["a"]) > FIRST_PART) & ~begun, False).otherwise(reached)

    cut_off = _stripped(a, b, lambda p, s: F.struct(_middle(a, p, s).alias("a"), _middle(b, p, s).alias("b")))
    return F.when(F.abs(F.char_length(a) - F.char_length(b)) > THRESHOLD, False).otherwise(_let(cut_off, ends))


def _towards(x, e):
    """The texts that x becomes by one edit where it first, or last, differs from e."""

    def made(p, s):
        n, m = F.char_length(x), F.char_length(e)
        until = n - s
        piece = lambda of, start, size: F.substring(of, start, size)
        head, tail = piece(x, F.lit(1), p), lambda start: piece(x, start, n)
        given, taken = piece(e, p + 1, F.lit(1)), piece(e, m - s, F.lit(1))
        front = [(p < n, F.concat(head, tail(p + 2))), (p < m, F.concat(head, given, tail(p + 1))), ((p < n) & (p < m), F.concat(head, given, tail(p + 2)))]
        left, right, drops, adds = piece(x, F.lit(1), until - 1), tail(until + 1), until > p, m - s > p
        back = [(drops, F.concat(left, right)), (adds, F.concat(piece(x, F.lit(1), until), taken, right)), (drops & adds, F.concat(left, taken, right))]
        return F.filter(F.array(*(F.when(known, text) for known, text in front + back)), lambda t: t.isNotNull())

    return _stripped(x, e, made)


def _states(text, used, e, rep):
    """Array of (kind, used, key, text): what lines meet on that are compared with the same text e; see ``late``."""

    def classed(t, n):
        key = lambda p, s: F.struct(F.lit("class").alias("kind"), n.alias("used"), F.when(4 * (p + s) >= F.char_length(e), F.xxhash64(F.lit(1), rep, p, s)).alias("key"), _middle(t, p, s).alias("text"))
        return _stripped(t, e, key)

    same = lambda t, n: F.struct(F.lit("same").alias("kind"), n.alias("used"), F.xxhash64(F.lit(2), rep, t).alias("key"), F.lit(None).cast("string").alias("text"))
    no = F.array().cast("array<string>")
    own = F.array(text)
    one = F.when(used < THRESHOLD, F.array_except(_towards(text, e), own)).otherwise(no)

    def all_of(once):
        twice = F.when(used == 0, F.array_except(F.flatten(F.transform(once, lambda t: _towards(t, e))), F.concat(own, once))).otherwise(no)
        classes = F.transform(F.when(used < THRESHOLD - 1, once).otherwise(no), lambda t: classed(t, used + 1))
        return F.concat(F.array(classed(text, used)), classes, F.array(same(text, used)), F.transform(once, lambda t: same(t, used + 1)), F.transform(twice, lambda t: same(t, used + 2)))

    return F.filter(_let(one, all_of), lambda x: x["key"].isNotNull())


def _patterns(text, times):
    """The texts with up to so many places open: a character of theirs, or one between."""
    places = lambda t: F.sequence(F.lit(1), F.char_length(t) + 1)
    filled = lambda t: F.transform(places(t), lambda i: F.concat(F.substring(t, F.lit(1), i - 1), F.lit(OPEN), F.substring(t, i + 1, F.char_length(t))))
    between = lambda t: F.transform(places(t), lambda i: F.concat(F.substring(t, F.lit(1), i - 1), F.lit(OPEN), F.substring(t, i, F.char_length(t))))
    out = F.array(text)
    for _ in range(times):
        out = _let(out, lambda every: F.array_distinct(F.concat(every, F.flatten(F.transform(every, lambda t: F.concat(filled(t), between(t)))))))
    return out


def _earliest(rows: DataFrame, key: str, *named) -> DataFrame:
    """For each key with several lines: under each name, the first line (struct of first, h1) of those that its condition holds for."""
    at = F.struct("first", "h1")
    found = rows.groupBy(key).agg(F.min("h1").alias("low"), F.max("h1").alias("high"), *(F.min(F.when(F.expr(condition), at)).alias(name) for name, condition in named))
    return found.filter("low <> high").drop("low", "high")


def _by_equality(states: DataFrame) -> DataFrame:
    """Pairs of lines that some edits make equal: the earliest of those with one edit at most stands for them; a line itself meets the rest."""
    groups = _earliest(states, "key", ("near", "used < 2"), ("own", "used = 0"))
    other = F.when(F.col("used") < 2, F.col("near.h1")).otherwise(F.col("own.h1"))
    return states.join(groups, "key").select(other.alias("a1"), F.col("h1").alias("b1")).filter("a1 <> b1")


def _by_pattern(items: DataFrame) -> DataFrame:
    """Pairs of lines whose short texts share a pattern, each with the earliest of the pattern."""
    out = []
    for times, part, other in ((2, "used = 0", "used = 0"), (1, "used < 2", "used = 1")):
        posts = items.filter(part).select("h1", "first", "used", F.explode(_patterns(F.col("text"), times)).alias("p"), "parent").select("h1", "first", "used", F.xxhash64(F.lit(3), "parent", "p").alias("key"))
        posts = cut(posts, "lines-patterns")
        groups = _earliest(posts, "key", ("own", "used = 0")).filter("own IS NOT NULL")
        out.append(posts.filter(other).join(groups, "key").select(F.col("own.h1").alias("a1"), F.col("h1").alias("b1")).filter("a1 <> b1"))
    return out[0].unionByName(out[1]).distinct()


def _representatives(hot: DataFrame, items: DataFrame) -> DataFrame:
    """item, key, k and rep: an early item, the same for most keys whose lines have much in common."""
    posts = hot.select("item", "key").distinct()
    labels = items.select("item", F.struct("first", "item").alias("label"))
    for step in range(STEPS):
        lowest = posts.join(labels, "item").groupBy("key").agg(F.min("label").alias("label"))
        if step + 1 < STEPS:
            labels = posts.join(lowest, "key").groupBy("item").agg(F.min("label").alias("label"))
    return cut(hot.join(lowest, "key").select("item", "key", "k", F.col("label.item").alias("rep")), "lines-reps")


def late(texts: DataFrame) -> DataFrame:
    """h1, h2, line, first (its first place) to h1, h2, late (true) of the lines that are near an earlier one; a cut table.

    Lines that share a key of few lines are candidates.  Those of a frequent key
    are compared with one line, the earliest that can be reached by a few steps
    from key to line: those near it are late.  For the others, what follows is
    exact, and takes rows in proportion to the lines, not to their pairs.  Of two near
    texts, either both differ from a third text e between the same places, or
    the one that differs from it first (or last) comes one edit nearer to the
    other by one of three edits there: its character goes, becomes that of e, or
    that of e comes before it.  So two near texts, each changed in this way with
    two edits together at most, become equal (then one earliest line stands for
    all), or differ from e between the same places, and go on with what lies
    between.  Where that is most of the text, they go on with what the key leaves of
    it.  Short texts meet on patterns with open places: all texts of
    one pattern are near each other, so again the earliest stands for all.
    """
    base = texts.select("h1", "h2", "first", F.struct("first", "h1", "h2").alias("at"), F.col("line"))
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    items = _itemised(base.select("h1", "first", F.lit(0).cast("long").alias("parent"), F.lit(0).alias("used"), F.col("line").alias("text")))
    pairs = []
    while True:
        posts = cut(_posted(items.filter(F.char_length("text") > SHORT - THRESHOLD), "text", "item", "h1", parent="parent"), "lines-posts")
        sizes = posts.groupBy("key").agg(F.min("h1").alias("low"), F.max("h1").alias("high"), F.max("indexed").alias("any"), F.count("*").alias("n"))
        sizes = cut(sizes.filter("low <> high and any").select("key", "n"), "lines-sizes")
        shared = cut(join_checked(posts, sizes, "key"), "lines-shared")
        few = shared.filter(F.col("n") <= FREQUENT).select("key", "h1", "indexed").distinct()
        index = few.filter("indexed").select("key", F.col("h1").alias("x"))
        met = index.join(few.select("key", F.col("h1").alias("y")), "key").filter("x <> y")
        pairs.append(_once(met.select(F.col("x").alias("a1"), F.col("y").alias("b1"))))
        hot = cut(shared.filter(F.col("n") > FREQUENT).select("item", "key", "k").distinct(), "lines-hot")
        forget(posts, sizes, shared)
        tiny = items.filter(F.char_length("text") <= SHORT)
        if not tiny.isEmpty():
            pairs.append(_once(_by_pattern(tiny)))
        if hot.isEmpty():
            break
        reps = _representatives(hot, items)
        e = items.select(F.col("item").alias("rep"), F.col("text").alias("e"), F.col("h1").alias("rep1"))
        both = reps.select("item", "rep").distinct().filter("rep <> item").join(items, "item").join(e, "rep").repartition(parts, "item")
        text, other = F.col("text"), F.col("e")
        # Texts that have little in common with their representative go on without the key's segment.
        alone = _stripped(text, other, lambda p, s: 4 * (p + s) < F.char_length(other) + 16)
        compared = cut(both.select("item", "h1", "first", "rep", "rep1", near(text, other).alias("near"), alone.alias("alone"), _states(text, F.col("used"), other, F.col("rep")).alias("states")), "lines-compared")
        pairs.append(_once(compared.filter("near").select(F.col("rep1").alias("a1"), F.col("h1").alias("b1"))))
        states = cut(compared.select("h1", "first", F.explode("states").alias("s")).select("h1", "first", "s.*").distinct(), "lines-states")
        pairs.append(_once(_by_equality(states.filter("kind = 'same'"))))
        classes = states.filter("kind = 'class'")
        several = classes.groupBy("key").agg(F.min("h1").alias("low"), F.max("h1").alias("high"), F.min("used").alias("least"), F.count("*").alias("n"))
        several = cut(several.filter("low <> high and least = 0").select("key", "n"), "lines-classes")
        classes = cut(join_checked(classes, several, "key"), "lines-between")
        few = classes.filter(F.col("n") <= FREQUENT)
        met = few.filter("used = 0").select("key", F.col("h1").alias("a1")).join(few.select("key", F.col("h1").alias("b1")), "key")
        pairs.append(_once(met.select("a1", "b1")))
        between = classes.filter(F.col("n") > FREQUENT).select("h1", "first", F.col("key").alias("parent"), "used", "text")
        lonely = compared.filter("alone").select("item", "rep").join(reps, ["item", "rep"]).join(items, "item")
        rest = _without(lonely).select("h1", "first", F.col("key").alias("parent"), "used", F.col("rest").alias("text"))
        left = _itemised(between.unionByName(rest))
        forget(hot, reps, compared, states, several, classes, items)
        items = left
    forget(items, hot)
    found = pairs[0]
    for more in pairs[1:]:
        found = found.unionByName(more)
    a, b = (base.select(F.col("h1").alias(f"{x}1"), F.col("line").alias(x), F.col("at").alias(f"{x}_at")) for x in "ab")
    both = found.distinct().join(a, "a1").join(b, "b1").filter(F.abs(F.char_length("a") - F.char_length("b")) <= THRESHOLD)
    both = both.repartition(parts, "a1", "b1").filter(near(F.col("a"), F.col("b")))
    out = cut(both.select(F.greatest("a_at", "b_at").alias("l")).select("l.h1", "l.h2").distinct().withColumn("late", F.lit(True)), "lines-late")
    forget(*pairs)
    return out


def _itemised(rows: DataFrame) -> DataFrame:
    return cut(rows.withColumn("item", F.xxhash64("parent", "h1", "used", "text")).dropDuplicates(["item", "h1"]), "lines-items")


def _once(pairs: DataFrame) -> DataFrame:
    return cut(pairs.select(F.least("a1", "b1").alias("a1"), F.greatest("a1", "b1").alias("b1")).filter("a1 <> b1").distinct(), "lines-pairs")


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", short: bool = False) -> DataFrame:
    """Texts that lose lines: doc, th, gone (for each line, whether it goes); a cut table."""
    part = F.col("size") >= LEAST_CHARS
    if short:
        part = part | F.col("line").rlike(_SEEN)
    place = (F.col("doc").cast("decimal(20,0)") * F.lit(1 << 31).cast("decimal(12,0)") + F.col("no")).cast("decimal(38,0)")
    every = lines(docs, id_col, text_col).withColumn("part", part).withColumn("place", place)
    long_lines = every.filter(F.col("size") >= LEAST_CHARS)
    met = _posted(long_lines, "line", "h1").groupBy("key").agg(F.min("h1").alias("low"), F.max("h1").alias("high"), F.max("indexed").alias("indexed"))
    met = cut(met.filter("low <> high and indexed").select("key"), "lines-keys")
    texts = join_checked(_posted(long_lines, "line", "h1", "h2", "line", "place"), met, "key")
    texts = cut(texts.groupBy("h1", "h2").agg(F.min("place").alias("first"), F.min("line").alias("line")), "lines-texts")
    gone = late(texts)
    forget(met, texts)
    firsts = every.filter("part").groupBy("h1", "h2").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    # Lines that occur once and are near no earlier one needn't be looked at again.
    marked = cut(join_checked(firsts, gone, ["h1", "h2"], "left").filter("n > 1 or late").select("h1", "h2", "first", F.coalesce("late", F.lit(False)).alias("late")), "lines-marked")
    told = join_checked(every.select("doc", "th", "no", "h1", "h2", "part", "place"), marked, ["h1", "h2"], "left")
    goes = F.col("part") & F.col("first").isNotNull() & (F.col("late") | (F.col("place") != F.col("first")))
    told = told.select("doc", "th", "no", F.coalesce(goes, F.lit(False)).alias("goes"))
    by_text = told.groupBy("doc", "th").agg(F.max("goes").alias("any"), F.sort_array(F.collect_set(F.struct("no", "goes"))).alias("gone"))
    out = cut(by_text.filter("any").select("doc", "th", F.col("gone.goes").alias("gone")), "lines-gone")
    forget(marked, gone)
    return out


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", short: bool = False) -> DataFrame:
    """docs with their own columns and without the later ones of near-equal lines; with ``short``, of equal short lines too."""
    name = "gone_" + uuid.uuid4().hex
    gone = decisions(docs, id_col, text_col, short)
    text = F.col(text_col).cast("string")
    joined = join_checked(docs, gone, (docs[id_col] == gone["doc"]) & (F.xxhash64(docs[text_col].cast("string")) == gone["th"]), "left")
    joined = joined.select(*[docs[c] for c in docs.columns], gone["gone"].alias(name))
    left = F.array_join(F.filter(F.split(text, "\n"), lambda x, i: ~F.get(F.col(name), i)), "\n")
    return joined.select(*[(F.when(F.col(name).isNull(), text).otherwise(left)).alias(c) if c == text_col else joined[c] for c in docs.columns])
