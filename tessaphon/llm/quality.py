"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model.

The model is one of characters within words: orders 1 to 5, each word with its
start and its end.  It is trained for each language on all trusted documents.
Documents are dealt into two folds by their text (copies fall together), and
each is scored by the model of the other fold, so no text is judged by a model
that has seen it, and every trusted document counts for the threshold.  A
document's statistic is its mean negative log probability for a character,
drawn towards its language's mean by a fixed number of characters, so that a few
words aren't judged by chance; it is rejected outside two outer quantiles of that
statistic on its language's trusted documents: text that is stranger than
theirs, and text that is likelier, as one word over and over often is.

A word's probability doesn't depend on its neighbours.  So texts are first
reduced to the counts of their words (long ones in pieces that know the four
characters before them), pre-aggregated.  Counts of
n-grams come from the words of trusted documents; continuation counts,
discounts, back-off weights and probabilities from joins of the count tables on
the history.

Scoring.  A model of one shard, of a bounded number of entries, is broadcast, and
each text is read once.  A larger one never passes through the driver: the
distinct n-grams of the corpus's distinct words are joined with it, order by order, on
(language, n-gram), and summed by word.  The most frequent words, of a bounded number, are
broadcast and summed where a document is read; the others, none of which can be a hot key any
more, are joined with the documents' word counts and summed by document.  All
tables of a join have one row for a key on one side at least, and are sharded by hash.
Both ways give the same sums.

Defined cases: a null or empty text has no words, no perplexity and is kept; a
null language is a language of its own; a document in a language of which the other
fold has no trusted text, or that has none to set a threshold, is kept; repeated rows
are judged alike; of contradicting labels the worst counts; empty tables give
empty results; the columns of docs stay as they are, whatever they are called.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, forget, frugal, join_checked, shrink

ORDER, QUANTILE, FOLDS, PRIOR_CHARS = 5, 0.995, 2, 200
#: Entries of a shard of the model; partial counts, words and n-grams remembered in a task in all; words that are broadcast;
#: characters of a long word's pieces; characters of texts that are scored together.
SHARD_ENTRIES, PARTIAL, REMEMBERED, HELD_WORDS, PIECE, TOGETHER = 4_000_000, 400_000, 500_000, 100_000, 24, 1 << 20
START, END = "\x02", "\x03"


def _grams(word: str) -> list[str]:
    padded = START * (ORDER - 1) + word + END
    return [padded[i : i + ORDER] for i in range(len(word) + 1)]


def _words(text: str) -> list[str]:
    if START in text or END in text:
        text = text.replace(START, "\ufffd").replace(END, "\ufffd")
    return text.split()


def _units(word: str) -> list[str]:
    """A word with its start and end; a long one in pieces, each after the characters that its first n-gram needs."""
    if len(word) <= PIECE:
        return [START + word + END]
    padded = START + word + END
    return [padded[: PIECE + 1]] + [padded[i - ORDER + 1 : i + PIECE] for i in range(PIECE + 1, len(padded), PIECE)]


def _unit_grams(unit: str) -> list[str]:
    padded = START * (ORDER - 2) + unit if unit[0] == START else unit
    return [padded[i : i + ORDER] for i in range(len(padded) - ORDER + 1)]


def _unit_counts(text: str) -> Counter:
    words = Counter(_words(text))
    out = Counter()
    for w, n in words.items():
        if len(w) <= PIECE:
            out[START + w + END] = n
        else:
            for u in _units(w):
                out[u] += n
    return out


def _lang(column: str = "lang"):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids of documents that are labelled good and not toxic, by all of their labels."""
    worst = labels.groupBy("doc_id").agg(F.min(F.coalesce("quality", F.lit(0))).alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t"))
    return worst.filter("q = 1 and t = 0").select("doc_id")


def unit_counts(texts: DataFrame) -> DataFrame:
    """lang, text, t (whether to train on it) to lang, unit, n, t: how often a word or piece occurs, in all texts and in those."""

    def count(batches):
        found, held = defaultdict(dict), 0
        for batch in batches:
            for lang, text, t in zip(batch[0].to_pylist(), batch[1], batch[2].to_pylist(), strict=True):
                own = found[lang]
                held -= len(own)
                for u, n in _unit_counts(text.as_py() or "").items():
                    at = own.get(u)
                    if at is None:
                        own[u] = [n, n if t else 0]
                    else:
                        at[0] += n
                        if t:
                            at[1] += n
                held += len(own)
                if held > PARTIAL:
                    yield from flush(found)
                    found.clear()
                    held = 0
        yield from flush(found)

    def flush(found):
        for lang, own in found.items():
            if own:
                both = list(own.values())
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own), pa.string()), pa.array(list(own), pa.string()), pa.array([x[0] for x in both], pa.int64()), pa.array([x[1] for x in both], pa.int64())], ["lang", "unit", "n", "t"])

    counted = texts.select("lang", "text", "t").mapInArrow(frugal(count), "lang string, unit string, n long, t long")
    return counted.groupBy("lang", "unit").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))


def ngram_counts(units: DataFrame) -> DataFrame:
    """lang, unit, n to lang, gram, n: how often each n-gram of the highest order occurs."""

    def count(batches):
        found, held = defaultdict(lambda: defaultdict(int)), 0
        for batch in batches:
            for lang, unit, n in zip(batch[0].to_pylist(), batch[1].to_pylist(), batch[2].to_pylist(), strict=True):
                grams = found[lang]
                held -= len(grams)
                for g in _unit_grams(unit):
                    grams[g] += n
                held += len(grams)
                if held > PARTIAL:
                    yield from flush(found)
                    found.clear()
                    held = 0
        yield from flush(found)

    def flush(found):
        for lang, grams in found.items():
            if grams:
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(list(grams), pa.string()), pa.array(list(grams.values()), pa.int64())], ["lang", "gram", "n"])

    return units.select("lang", "unit", "n").mapInArrow(frugal(count), "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def train(texts: DataFrame) -> DataFrame:
    """lang, text to a cut table of the model; see ``estimate``."""
    return estimate(unit_counts(texts.select("lang", "text", F.lit(True).alias("t"))))


def estimate(units: DataFrame) -> DataFrame:
    """lang, unit, n to a cut table of the model: lang, part, gram, value.

    part "p": log probability of the gram's last character after the others;
    part "b": log back-off weight of the gram as a history.
    """
    tables = {ORDER: cut(ngram_counts(units).withColumn("a", F.col("n")), "kn-counts")}
    for k in range(ORDER - 1, 0, -1):
        up = tables[k + 1].groupBy("lang", F.substring("gram", 2, k).alias("gram")).agg(F.sum("n").alias("n"), F.count("*").alias("c"))
        # What begins a word has no character before it: its own count stands in for the continuation count.
        tables[k] = cut(up.select("lang", "gram", "n", F.when(F.col("gram").startswith(START), F.col("n")).otherwise(F.col("c")).alias("a")), "kn-counts")
    model, lower, done = None, None, []
    for k in range(1, ORDER + 1):
        t = tables[k].filter(~F.col("gram").endswith(START)).withColumn("h", F.substring("gram", 1, k - 1))
        ones = [F.sum((F.col("a") == i).cast("double")).alias(f"n{i}") for i in (1, 2, 3, 4)]
        n1, n2, n3, n4 = (F.greatest(F.col(f"n{i}"), F.lit(1.0)) for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2)
        within = lambda x, top: F.least(F.greatest(x, F.lit(0.1)), F.lit(top))
        cuts = t.groupBy("lang").agg(*ones, F.count("*").cast("double").alias("kinds")).select("lang", "kinds", within(1 - 2 * y * n2 / n1, 0.9).alias("d1"), within(2 - 3 * y * n3 / n2, 1.9).alias("d2"), within(3 - 4 * y * n4 / n3, 2.9).alias("d3"))
        cuts = cut(cuts, "kn-discounts")
        t = join_checked(t, cuts, "lang")
        off = F.when(F.col("a") == 1, F.col("d1")).when(F.col("a") == 2, F.col("d2")).otherwise(F.col("d3"))
        t = cut(t.withColumn("off", F.least(off, F.col("a").cast("double"))), "kn-order")
        histories = cut(t.groupBy("lang", "h").agg(F.sum("a").alias("total"), F.sum("off").alias("freed")), "kn-histories")
        done += [t, cuts, histories]
        t = t.join(histories, ["lang", "h"])
        if lower is None:
            below = 1.0 / (F.col("kinds") + 1)
        else:
            t = t.join(lower.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("below")), (t["lang"] == lower["lang"]) & (F.substring("gram", 2, k - 1) == F.col("suffix"))).drop(lower["lang"])
            below = F.col("below")
        p = (F.col("a") - F.col("off")) / F.col("total") + F.col("freed") / F.col("total") * below
        lower = cut(t.select("lang", "gram", p.alias("p"), "kinds"), "kn-probabilities")
        part = lower.select("lang", F.lit("p").alias("part"), "gram", F.log("p").alias("value"))
        back = histories.select("lang", F.lit("b").alias("part"), F.col("h").alias("gram"), F.log(F.col("freed") / F.col("total")).alias("value"))
        if k == 1:  # an unknown character: the weight of the empty history, spread over all kinds
            kinds = cuts.select("lang", "kinds")
            back = join_checked(back, cut(kinds, "kn-kinds"), "lang").select("lang", "part", "gram", (F.col("value") - F.log(F.col("kinds") + 1)).alias("value"))
        model = part.unionByName(back) if model is None else model.unionByName(part).unionByName(back)
        done.append(lower)
    out = cut(model, "kn-model")
    forget(*done, *tables.values())
    return out


class Shard:
    """A model of one shard in a worker: sorted keys and values.

    Values of words and n-grams are remembered in two generations of a bounded number of entries, however many
    languages there are; what isn't remembered is looked up for many at once.
    """

    def __init__(self, keys, values):
        import xxhash

        self.keys, self.values, self.hash = keys, values, xxhash.xxh64_intdigest
        self.seeds, self.young, self.old, self.held = {}, {}, {}, 0

    def find(self, seed: int, grams: list[str]):
        """(whether an entry is there, its value or 0) for n-grams of one language and part."""
        if not len(self.keys) or not grams:
            return np.zeros(len(grams), bool), np.zeros(len(grams))
        digest = self.hash
        asked = np.array([digest(g.encode(), seed) for g in grams], np.uint64)
        at = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
        there = self.keys[at] == asked
        return there, np.where(there, self.values[at], 0.0)

    def known(self, lang: str) -> bool:
        if lang not in self.seeds:
            own = self.hash(lang.encode(), 42)
            seeds = self.hash(b"p", own), self.hash(b"b", own)
            self.seeds[lang] = seeds if self.find(seeds[1], [""])[0][0] else None
        return self.seeds[lang] is not None

    def grams(self, lang: str, grams: list[str]) -> list[float]:
        """Log probabilities of the last characters; an unseen history has no back-off weight and passes on."""
        of_gram, of_history = self.seeds[lang]
        out, weight, left = np.zeros(len(grams)), np.zeros(len(grams)), np.arange(len(grams))
        for k in range(ORDER, 0, -1):
            ends = [grams[i][-k:] for i in left.tolist()]
            there, value = self.find(of_gram, ends)
            out[left[there]] = weight[left[there]] + value[there]
            left = left[~there]
            weight[left] += self.find(of_history, [e[:-1] for e, t in zip(ends, there.tolist(), strict=True) if not t])[1]
        out[left] = weight[left]
        return out.tolist()

    def units(self, lang: str, units) -> dict[str, float] | None:
        """Negative log probabilities of a language's words and pieces, those asked for among others; None if the model doesn't know it."""
        if not self.known(lang):
            return None
        if self.held > REMEMBERED:
            self.old, self.young, self.held = self.young, {}, 0
        (words, values), (old_words, old_values) = self.young.setdefault(lang, ({}, {})), self.old.get(lang, ({}, {}))
        before, new = len(words) + len(values), []
        for u in units:
            if u not in words:
                known = old_words.get(u)
                if known is None:
                    new.append((u, _unit_grams(u)))
                else:
                    words[u] = known
        wanted, missing = set(), []
        for _, own in new:
            wanted.update(own)
        for g in wanted - values.keys():
            known = old_values.get(g)
            if known is None:
                missing.append(g)
            else:
                values[g] = known
        values.update(zip(missing, self.grams(lang, missing), strict=True))
        get = values.__getitem__
        for u, own in new:
            words[u] = -sum(map(get, own))
        self.held += len(words) + len(values) - before
        return words


class Model:
    """A trained model, sharded by hash into parts of a bounded number of entries on average."""

    def __init__(self, table: DataFrame):
        self.table = table
        self.shards = range(max(1, -(-table.count() // SHARD_ENTRIES)))
        self.parts = max(len(self.shards), int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        self.langs = cut(table.filter("part = 'b' and gram = ''").select("lang"), "kn-langs")

    def of_grams(self, grams: DataFrame) -> DataFrame:
        """lang, gram (distinct, of the highest order) to lang, gram, value: log probabilities of the last character; a cut table."""
        wanted, below = {ORDER: grams}, None
        for k in range(ORDER - 1, 0, -1):
            wanted[k] = cut(wanted[k + 1].select("lang", F.expr(f"substring(gram, 2, {k})").alias("gram")).distinct(), "kn-wanted")
        table = self.table.withColumn("size", F.length("gram"))
        for k in range(1, ORDER + 1):
            p = table.filter((F.col("part") == "p") & (F.col("size") == k)).select("lang", "gram", F.col("value").alias("p"))
            b = table.filter((F.col("part") == "b") & (F.col("size") == k - 1)).select("lang", F.col("gram").alias("h"), F.col("value").alias("b"))
            asked = wanted[k].withColumn("h", F.substring("gram", 1, k - 1)).withColumn("rest", F.substring("gram", 2, k - 1))
            known = asked.repartition(self.parts, "lang", "gram").join(p, ["lang", "gram"], "left").join(b, ["lang", "h"], "left")
            back = F.coalesce("b", F.lit(0.0))
            if below is None:
                out = known.select("lang", "gram", F.coalesce("p", back).alias("value"))
            else:
                less = below.select("lang", F.col("gram").alias("rest"), F.col("value").alias("less"))
                out = known.join(less, ["lang", "rest"]).select("lang", "gram", F.coalesce(F.col("p"), back + F.col("less")).alias("value"))
            above, below = below, cut(out, "kn-values")
            if above is not None:
                forget(above)
        forget(*(wanted[k] for k in range(1, ORDER)))
        return below

    def of_units(self, units: DataFrame) -> DataFrame:
        """lang, unit, n to those and nll, for the languages that the model knows; a cut table."""

        def grams(batches):
            for batch in batches:
                found = [_unit_grams(unit) for unit in batch[1].to_pylist()]
                each = pa.array(np.repeat(np.arange(batch.num_rows), list(map(len, found))))
                yield pa.RecordBatch.from_arrays([*(c.take(each) for c in batch.columns), pa.array([g for own in found for g in own], pa.string())], ["lang", "unit", "n", "gram"])

        known = join_checked(units, self.langs, "lang", "left_semi")
        spread = known.select("lang", "unit", "n").mapInArrow(frugal(grams), "lang string, unit string, n long, gram string")
        values = self.of_grams(cut(spread.select("lang", "gram").distinct(), "kn-grams"))
        out = cut(join_checked(spread, values, ["lang", "gram"]).groupBy("lang", "unit", "n").agg((-F.sum("value")).alias("nll")), "kn-units")
        forget(values)
        return out

    def of_texts(self, texts: DataFrame) -> DataFrame:
        """lang, k1, k2 (what tells a text), text to lang, k1, k2, nll, n, once for each text; a cut table."""
        return self._broadcast(texts) if len(self.shards) == 1 else self._joined(texts)

    def _broadcast(self, texts: DataFrame) -> DataFrame:
        rows = self.table.select(F.xxhash64("lang", "part", "gram").alias("key"), "value").toArrow()
        keys = rows["key"].to_numpy().view(np.uint64)
        order = np.argsort(keys)
        shrink(texts.sparkSession)
        held = texts.sparkSession.sparkContext.broadcast((keys[order], rows["value"].to_numpy()[order]))

        def score(batches):
            shard = Shard(*held.value)  # for one task: a worker that waits remembers nothing
            for batch in batches:
                sums, sizes, waiting, chars = [0.0] * batch.num_rows, [], defaultdict(list), 0
                for i, (lang, text) in enumerate(zip(batch[0].to_pylist(), batch[3], strict=True)):
                    text = text.as_py() or ""
                    counts = _unit_counts(text)
                    sizes.append(sum(n * (len(u) - (1 if u[0] == START else ORDER - 1)) for u, n in counts.items()))
                    waiting[lang].append((i, counts))
                    chars += len(text)
                    if chars > TOGETHER or i == batch.num_rows - 1:
                        for own, texts in waiting.items():
                            known = shard.units(own, {u for _, c in texts for u in c})
                            if known is not None:
                                for at, c in texts:
                                    sums[at] = math.fsum(n * known[u] for u, n in c.items())
                        waiting.clear()
                        chars = 0
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sums, pa.float64()), pa.array(sizes, pa.int64())], ["lang", "k1", "k2", "nll", "n"])

        scored = texts.select("lang", "k1", "k2", "text").mapInArrow(frugal(score), "lang string, k1 long, k2 long, nll double, n long")
        out = cut(scored.groupBy("lang", "k1", "k2").agg(F.max("nll").alias("nll"), F.max("n").alias("n")), "kn-texts")
        held.unpersist()
        return out

    def _joined(self, texts: DataFrame) -> DataFrame:
        units = cut(unit_counts(texts.withColumn("t", F.lit(False))), "kn-words")
        spark = texts.sparkSession
        scored = self.of_units(units)
        level = F.floor(F.log2("n") * 8)
        # As many rows as there are levels: some hundreds.
        room, least = HELD_WORDS, None
        for r in scored.groupBy(level.alias("level")).agg(F.count("*").alias("c")).orderBy(F.desc("level")).collect():
            room -= r["c"]
            if room < 0:
                break
            least = r["level"]
        often = level >= (1 << 30 if least is None else least)
        held = spark.sparkContext.broadcast([c.to_pylist() for c in scored.filter(often).select("lang", "unit", "nll").toArrow().columns])
        known = {r["lang"] for r in self.langs.filter("lang is not null").limit(LANGUAGES).collect()}
        everything = len(known) < LANGUAGES

        def ask(batches):
            own = defaultdict(dict)
            for lang, unit, nll in zip(*held.value, strict=True):
                own[lang][unit] = nll
            langs, first, second, units, counts, sums, sizes = columns = [[] for _ in range(7)]
            for batch in batches:
                for lang, k1, k2, text in zip(*(batch[c].to_pylist() for c in range(3)), batch[3], strict=True):
                    there, total, size = own[lang], 0.0, 0
                    skip = everything and lang not in known
                    for u, n in _unit_counts(text.as_py() or "").items():
                        size += n * (len(u) - (1 if u[0] == START else ORDER - 1))
                        nll = 0.0 if skip else there.get(u)
                        if nll is None:
                            for column, value in zip(columns, (lang, k1, k2, u, n, None, None), strict=True):
                                column.append(value)
                        else:
                            total += n * nll
                    for column, value in zip(columns, (lang, k1, k2, None, None, total, size), strict=True):
                        column.append(value)
                    if len(langs) > 50_000:
                        yield packed(columns)
                        for column in columns:
                            column.clear()
            yield packed(columns)

        def packed(columns):
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.float64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], ["lang", "k1", "k2", "unit", "c", "nll", "n"])

        asked = cut(texts.select("lang", "k1", "k2", "text").mapInArrow(frugal(ask), "lang string, k1 long, k2 long, unit string, c int, nll double, n long"), "kn-asked")
        rare = scored.filter(~often).select("lang", "unit", F.col("nll").alias("each"))
        met = asked.filter("unit IS NOT NULL").join(rare, ["lang", "unit"]).select("lang", "k1", "k2", "unit", (F.col("c") * F.col("each")).alias("nll"), F.lit(None).cast("long").alias("n"))
        every = asked.filter("unit IS NULL").select("lang", "k1", "k2", "unit", "nll", "n").unionByName(met)
        # A text that stands on several rows has asked several times.
        once = every.groupBy("lang", "k1", "k2", "unit").agg(F.max("nll").alias("nll"), F.max("n").alias("n"))
        out = cut(once.groupBy("lang", "k1", "k2").agg(F.sum("nll").alias("nll"), F.sum("n").alias("n")), "kn-texts")
        forget(asked, scored, units)
        held.unpersist()
        return out

    def score(self, df: DataFrame, lang, text, out: str) -> DataFrame:
        """Add a column ``out``: STRUCT<nll: double, n: long>."""
        keyed = df.select(lang.alias("lang"), *_content(text), text.alias("text"))
        scores = self.of_texts(keyed)
        return _with_given(df, scores.select("lang", "k1", "k2", F.struct("nll", "n").alias("given")), lang, text, out)


#: Languages up to which a list of them is sent along, so that others needn't be asked about.
LANGUAGES = 10_000


def _content(text) -> list:
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


def _keyed(df: DataFrame, lang, text, tag: str) -> DataFrame:
    k1, k2 = _content(text)
    return df.select("*", lang.alias(f"l_{tag}"), k1.alias(f"a_{tag}"), k2.alias(f"b_{tag}"))


def _of_text(rows: DataFrame, tag: str, *more) -> tuple[DataFrame, object]:
    """rows of lang, k1, k2 under names of their own, and the condition that a row of ``_keyed`` has their text."""
    named = rows.select(*(F.col(x).alias(f"{x}_{tag}") for x in ("lang", "k1", "k2")), *more)
    same = [F.col(f"{x}_{tag}") == F.col(f"{y}_{tag}") for x, y in (("l", "lang"), ("a", "k1"), ("b", "k2"))]
    return named, same[0] & same[1] & same[2]


def _with_given(df: DataFrame, rows: DataFrame, lang, text, out: str) -> DataFrame:
    tag = uuid.uuid4().hex
    given, same = _of_text(rows, tag, F.col("given").alias(out))
    return _keyed(df, lang, text, tag).join(given, same, "left").select(*df.columns, out)


def _scores(docs: DataFrame, labels: DataFrame, quantile: float) -> tuple[DataFrame, DataFrame]:
    """Cut tables: lang (with fold), k1, k2, nll, n of all texts; lang, mean, low, high of the trusted ones."""
    ids = cut(trusted_ids(labels).withColumnRenamed("doc_id", "trusted"), "kn-trusted")
    text = _text()
    base = docs.select(_lang_fold(text).alias("lang"), *_content(text), text.alias("text"), F.col("doc_id").alias("id"))
    trusted = join_checked(base, ids, F.col("id") == F.col("trusted"), "left_semi")
    other = F.concat(F.expr("substring(lang, 1, length(lang) - 1)"), (F.lit(FOLDS - 1) - F.substring("lang", -1, 1).cast("int")).cast("string"))
    units = unit_counts(trusted.select("lang", "text", F.lit(True).alias("t")))
    table = estimate(units.select(other.alias("lang"), "unit", "n"))
    model = Model(table)
    scores = model.of_texts(base)
    keys = trusted.select("lang", "k1", "k2")
    plain = F.expr("substring(lang, 1, length(lang) - 2)")
    held = keys.join(scores, ["lang", "k1", "k2"]).filter("n > 0")
    held = join_checked(held, model.langs, "lang", "left_semi").select(plain.alias("lang"), "nll", "n")
    # One row for a language: broadcast, so that the quantiles' sketches are made where the rows are.
    means = cut(held.groupBy("lang").agg((F.sum("nll") / F.sum("n")).alias("mean")), "kn-means")
    drawn = join_checked(held, means, "lang").withColumn("s", (F.col("nll") + PRIOR_CHARS * F.col("mean")) / (F.col("n") + PRIOR_CHARS))
    tail = (1 - quantile) / 2
    limits = drawn.groupBy("lang").agg(F.first("mean").alias("mean"), F.percentile_approx("s", tail, 100_000).alias("low"), F.percentile_approx("s", 1 - tail, 100_000).alias("high"))
    # A language's limits hold for texts that the other fold has a model for.
    limits = model.langs.join(limits.withColumnRenamed("lang", "plain"), plain == F.col("plain")).select("lang", "mean", "low", "high")
    limits = cut(limits, "kn-limits")
    forget(table, ids)
    return scores, limits


def _lang_fold(text):
    """A language and the fold of a text: the model that scores it."""
    return F.concat(_lang(), F.lit("/"), F.pmod(F.xxhash64(F.lit(2), text), F.lit(FOLDS)).cast("string"))


def _with_verdicts(scores: DataFrame, limits: DataFrame) -> DataFrame:
    """lang, k1, k2, given: STRUCT<perplexity, statistic, least, threshold, keep>."""
    nll, n = F.col("nll"), F.col("n")
    known = F.col("high").isNotNull() & (n > 0)
    drawn = (nll + PRIOR_CHARS * F.col("mean")) / (n + PRIOR_CHARS)
    keep = F.coalesce(~known | drawn.between(F.col("low"), F.col("high")), F.lit(True))
    given = F.struct(F.when(known, F.exp(nll / n)).alias("perplexity"), F.when(known, F.exp(drawn)).alias("statistic"), F.exp("low").alias("least"), F.exp("high").alias("threshold"), keep.alias("keep"))
    return join_checked(scores, limits, "lang", "left").select("lang", "k1", "k2", given.alias("given"))


def _text():
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def judge(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> tuple[DataFrame, str]:
    """docs with one more column: STRUCT<perplexity, statistic, least, threshold, keep>; and that column's name."""
    own = "quality_" + uuid.uuid4().hex
    return _with_given(docs, _with_verdicts(*_scores(docs, labels, quantile)), _lang_fold(_text()), _text(), own), own


def keep_good(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """The documents that aren't rejected, with their own columns."""
    tag = uuid.uuid4().hex
    scores, limits = _scores(docs, labels, quantile)
    gone, same = _of_text(_with_verdicts(scores, limits).filter(~F.col("given")["keep"]), tag)
    gone = cut(gone, "kn-gone")
    forget(scores, limits)
    return join_checked(_keyed(docs, _lang_fold(_text()), _text(), tag), gone, same, "left_anti").select(*docs.columns)
