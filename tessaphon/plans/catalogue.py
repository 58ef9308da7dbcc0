"""Driver queries over the tables, by role, with their DuckDB counterparts.

Rows of ``embeddings`` are equally long chunks of a class; ``events`` of a user
are a recording (value by time) and its phone intervals (event_type).  Scaled
whole numbers, floor(x * scale + 0.5), compare exactly in both engines.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Decoding
from ..functions import arrays, names
from ..functions.hashing import digest
from ..kernels import spectral, udfs
from ..operators import analysis, chunks, mixing, phonemes
from ..operators.positions import with_position
from ..sources import archives, audio, textgrid
from ..sources.staging import folder_of

SEED, RATE, SECONDS = 7, 2, 2.0
N_FFT, HOP, MELS, COEFFICIENTS, PITCHES, TOY_SR = 32, 16, 8, 5, 12, 64
PHONES = ("<p:>", "?", "h\\", "a:", "S")
WAV_RATE = 8000


def _read(spark, sf_dir, table):
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _scaled(column, scale):
    return F.floor(column * F.lit(float(scale)) + F.lit(0.5)).cast("long")


def _class(spark, sf_dir, label):
    return _read(spark, sf_dir, "embeddings").filter(F.col("label") == label).select("vec_id", F.col("embedding").alias("y"))


def _recordings(spark, sf_dir):
    events = _read(spark, sf_dir, "events").select("user_id", F.struct("ts", "event_id", F.col("value").cast("float").alias("value")).alias("s"))
    told = events.groupBy("user_id").agg(F.array_sort(F.collect_list("s")).alias("s"))
    return told.select(F.col("user_id").alias("file_name"), F.lit(RATE).alias("sr"), F.col("s.value").alias("y"))


def _exploded(df, scale, *keep):
    return df.select(*keep, F.posexplode("y").alias("k", "v")).select(*keep, "k", _scaled(F.col("v").cast("double"), scale).alias("v"))


def chunk_query(keep_tail):
    def run(spark, sf_dir):
        cut = chunks.chunk(_recordings(spark, sf_dir), SECONDS, keep_tail)
        total = F.aggregate(F.transform("y", lambda v: _scaled(v.cast("double"), 1e3)), F.lit(0).cast("long"), lambda a, b: a + b)
        return cut.select(F.col("file_name").alias("user_id"), F.col("chunk_idx").cast("long").alias("chunk_idx"), F.size("y").cast("long").alias("n"), total.alias("total"))

    return run


def file_totals(spark, sf_dir):
    t = chunks.file_totals(_recordings(spark, sf_dir), SECONDS)
    return t.select(F.col("file_name").alias("user_id"), _scaled(F.col("total_duration_sec"), 1e3).alias("ms"), F.col("num_chunks").cast("long").alias("num_chunks"))


def chunk_summary(spark, sf_dir):
    s = chunks.summary(chunks.file_totals(_recordings(spark, sf_dir), SECONDS))
    return s.select(F.col("chunks").cast("long").alias("chunks"), _scaled(F.col("seconds"), 1e3).alias("ms"))


def pitch_augment_rows(spark, sf_dir):
    e = _read(spark, sf_dir, "embeddings").select("vec_id")
    return chunks.augment(e, "vec_id", SEED).select("vec_id", F.col("variant").cast("long").alias("variant"), F.col("steps").cast("long").alias("steps"), "ord")


def mix_aligned(percent, start):
    def run(spark, sf_dir):
        mixed = mixing.mix_aligned_subset(_class(spark, sf_dir, 5), _class(spark, sf_dir, 6), percent, "vec_id", SEED, start)
        return _exploded(mixed, 1e5, "i", "rk")

    return run


def mix_random_background(spark, sf_dir):
    mixed = mixing.masking_dataset(_class(spark, sf_dir, 5), _class(spark, sf_dir, 6), "mask", "vec_id", SEED)
    return _exploded(mixed, 1e5, "fg", "bg", "label")


def _synthetic_lines(spark, sf_dir):
    """Events as lines of alignment files: per user a word tier, then a phone tier."""
    place = with_position(_read(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), ["user_id"], "event_id")
    quote = lambda c: F.concat(F.lit('text = "'), c, F.lit('"'))
    label = F.when(F.pmod("event_id", F.lit(7)) == 0, F.lit("")).otherwise(F.col("event_type"))
    bounds = [F.concat(F.lit("  xmin = "), F.col("i").cast("string")), F.concat(F.lit("xmax = "), (F.col("i") + 1).cast("string"))]
    body = place.select("user_id", (F.col("i") * 3 + 10).alias("at"), F.posexplode(F.array(*bounds, quote(label))).alias("j", "line")).select("user_id", (F.col("at") + F.col("j")).alias("line_no"), "line")
    head = place.select("user_id").distinct().select("user_id", F.posexplode(F.array(*map(F.lit, ('name = "ORT-MAU"', 'text = "word"', 'name = "MAU"', "xmin = 0", "xmax = 9")))).alias("line_no", "line"))
    return head.unionByName(body).withColumnRenamed("user_id", "sample_id")


def alignment_parse(spark, sf_dir):
    found = textgrid.phone_intervals(_synthetic_lines(spark, sf_dir))
    return found.select(F.col("sample_id").alias("user_id"), F.col("ord").cast("long").alias("ord"), "phone", "t0", "t1")


def _intervals(spark, sf_dir):
    events = _read(spark, sf_dir, "events")
    return events.select(F.col("user_id").alias("sample_id"), F.col("event_type").alias("phone"), F.lit(0.0).alias("t0"), (F.col("value") / 1000.0).alias("t1"))


def phone_counts(spark, sf_dir):
    return phonemes.counts(_intervals(spark, sf_dir), 0.02)


def phone_counts_by_sample(spark, sf_dir):
    return phonemes.counts(_intervals(spark, sf_dir), 0.02, per_sample=True)


def phone_safe_name(spark, sf_dir):
    phone = F.element_at(F.array(*map(F.lit, PHONES)), (F.pmod("event_id", F.lit(len(PHONES))) + 1).cast("int"))
    return _read(spark, sf_dir, "events").select("event_id", names.safe_name(phone).alias("safe_name"))


def interp_to_length(spark, sf_dir):
    series = _read(spark, sf_dir, "embeddings").select("vec_id", F.size("embedding").alias("len"), F.col("embedding").cast("array<double>").alias("data"))
    return _exploded(phonemes.to_length(series, 100).withColumnRenamed("data", "y"), 1e5, "vec_id")


def extreme_timeframe(shortest):
    def run(spark, sf_dir):
        r = _recordings(spark, sf_dir)
        series = r.select("file_name", F.size("y").alias("len"), F.col("y").cast("array<double>").alias("data"))
        out = phonemes.to_extreme_length(series, shortest).select(F.col("file_name").alias("user_id"), F.col("data").alias("y"))
        return _exploded(out, 1e3, "user_id")

    return run


def amplitude_scale(spark, sf_dir):
    e = _read(spark, sf_dir, "embeddings").select("vec_id", arrays.scale(F.col("embedding").cast("array<double>"), 0.5).alias("y"))
    return _exploded(e, 1e5, "vec_id")


def stft_magnitude(spark, sf_dir):
    e = _read(spark, sf_dir, "embeddings").select("vec_id", udfs.framed_power(N_FFT, HOP)("embedding").alias("y"))
    return _exploded(e, 1e4, "vec_id")


def _kernel(kernel, scale):
    def run(spark, sf_dir):
        return _exploded(_read(spark, sf_dir, "embeddings").select("vec_id", udfs.flat(kernel)("embedding").alias("y")), scale, "vec_id")

    return run


def _mel(y):
    return spectral.mel(y, TOY_SR, N_FFT, HOP, None, MELS, center=False).T


def _mfcc(y):
    return spectral.mfcc(y, TOY_SR, COEFFICIENTS, MELS, N_FFT, HOP, center=False).T


def _chroma(y):
    return spectral.chroma(y, 2048, N_FFT, HOP, None, PITCHES, center=False).T


def already_done_anti(spark, sf_dir):
    return phonemes.already_done(_read(spark, sf_dir, "documents").select("doc_id", "source"), _read(spark, sf_dir, "labels"), "doc_id")


def class_distinct(spark, sf_dir):
    return _read(spark, sf_dir, "embeddings").select("label").distinct()


def flatten_union(spark, sf_dir):
    parts = [_class(spark, sf_dir, k).select(F.lit(k).alias("class"), "vec_id") for k in (5, 6)]
    return parts[0].unionByName(parts[1])


def first_three_files(spark, sf_dir):
    e = _read(spark, sf_dir, "embeddings")
    return e.join(e.select("label").distinct().orderBy("label").limit(3), "label", "left_semi").select("label", "vec_id")


def shuffle_paired(spark, sf_dir):
    from ..operators.positions import sample_rank

    return sample_rank(_read(spark, sf_dir, "embeddings").select("vec_id", "label"), SEED, "shuffle", "vec_id").select("vec_id", "label", F.col("rk").alias("place"))


def kmeans_assign(spark, sf_dir):
    e = _read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    first = [list(r["embedding"]) for r in e.filter("vec_id < 6").orderBy("vec_id").collect()]
    return analysis.nearest_centroid(e, "embedding", first).select("vec_id", "cluster")


def cluster_subset(spark, sf_dir):
    return kmeans_assign(spark, sf_dir).filter(F.col("cluster") == 0).select("vec_id")


def kmeans_step(spark, sf_dir):
    e = _read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    first = [list(r["embedding"]) for r in e.filter("vec_id < 6").orderBy("vec_id").collect()]
    step = analysis.lloyd_step(e, "embedding", first).withColumnRenamed("centroid", "y")
    return _exploded(step, 1e5, "cluster", "n")


def wav_files(spark, sf_dir):
    """Recordings written as WAV files and read again by the folder source."""
    folder = folder_of(spark, "wavs")
    r = _recordings(spark, sf_dir).select("file_name", F.transform("y", lambda v: F.least(v.cast("double"), F.lit(1000.0)) / 1000).alias("y"))
    archives.dump_wavs(r, folder, F.concat(F.lit("user."), F.lpad(F.col("file_name").cast("string"), 9, "0")), WAV_RATE)
    back = audio.recordings(audio.ordered(audio.audio_files(spark, folder)), Decoding(rate=None))
    user = F.regexp_extract("file_name", r"(\d+)\.wav$", 1).cast("long").alias("user_id")
    found = back.select(user, F.col("file_ord").cast("long").alias("file_ord"), "sr", F.posexplode("y").alias("k", "v"))
    return found.select("user_id", "file_ord", "sr", "k", F.round(F.col("v").cast("double") * 32768).cast("long").alias("v"))


def npz_archives(spark, sf_dir):
    """Features written as one archive for each class and read again."""
    folder = folder_of(spark, "npz")
    e = _read(spark, sf_dir, "embeddings")
    rows = e.select(F.col("label").cast("string").alias("label"), F.col("vec_id").alias("arr_idx"), F.array(F.lit(8), F.lit(8)).alias("shape"), F.lit("float32").alias("dtype"), F.col("embedding").alias("re"), F.lit(None).cast("array<float>").alias("im"))
    archives.write_npz(rows, folder).count()
    back = archives.read_npz(spark, folder)
    return _exploded(back.select(F.col("label").cast("int").alias("label"), "arr_idx", F.element_at("shape", 2).alias("width"), F.col("re").alias("y")), 1e5, "label", "arr_idx", "width")


def feature_table(spark, sf_dir):
    """Phones written as a feature table by safe name, and read again."""
    folder = folder_of(spark, "features")
    phone = F.element_at(F.array(*map(F.lit, (*PHONES, ""))), (F.pmod("event_id", F.lit(len(PHONES) + 1)) + 1).cast("int"))
    archives.write_features(_read(spark, sf_dir, "events").select(phone.alias("label"), "event_id"), folder)
    return archives.read_features(spark, folder).groupBy("label", "safe_name").agg(F.count("*").alias("n"), F.sum("event_id").alias("total"))


def kmeans_fit(spark, sf_dir):
    return analysis.clusters(_read(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "embedding", 6, SEED).select("vec_id", "cluster")


def analysis_frame(spark, sf_dir):
    return analysis.analysis_frame(_read(spark, sf_dir, "embeddings"), "label", "embedding", 6, SEED)


def pca_project(spark, sf_dir):
    out = analysis.components(_read(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "embedding", 3)
    return out.select("vec_id", *[_scaled(F.col(f"pc{j}"), 1e5).alias(f"pc{j}") for j in (1, 2, 3)])


def pitch_shift(spark, sf_dir):
    e = _read(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("y"))
    return _exploded(chunks.shift_pitch(chunks.augment(e, "vec_id", SEED)).filter("variant = 1"), 1e4, "vec_id", "steps")


def time_stretch(spark, sf_dir):
    e = _read(spark, sf_dir, "embeddings").select("vec_id", udfs.time_stretch(1.25)("embedding").alias("y"))
    return _exploded(e, 1e4, "vec_id")


def constant_timeframe(spark, sf_dir):
    # Rows grow to 29,400 samples: they are dealt out first, since a file of one row group would go to one task.
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    dealt = _read(spark, sf_dir, "embeddings").select("vec_id", "embedding").repartition(parts)
    e = dealt.select("vec_id", udfs.constant_timeframe()("embedding").alias("y"))
    return e.select("vec_id", F.size("y").cast("long").alias("n"))


def mel_to_audio_mix(spark, sf_dir):
    def mels(label):
        kernel = udfs._features(lambda y: spectral.mel(y, 22050, 256, 64, None, 16))
        return _class(spark, sf_dir, label).select("vec_id", kernel("y").alias("f")).select("vec_id", F.col("f.re").alias("y"), F.col("f.shape").alias("shape"))

    return _exploded(mixing.mix_mels(mels(5), mels(6), 0.5, "vec_id", SEED, 64, 22050, 256), 1e3, "i", "rk")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class 5 over random backgrounds of class 6: mean magnitude of each bin over the frames of all mixes."""
    mixed = mixing.mix_random_background(_class(spark, sf_dir, 5), _class(spark, sf_dir, 6), "vec_id", SEED)
    power = mixed.select(F.posexplode(udfs.framed_power(N_FFT, HOP)("y")).alias("k", "m"))
    return power.groupBy((F.col("k") % (N_FFT // 2 + 1)).alias("bin")).agg(F.avg("m").alias("magnitude")).orderBy("bin")


def queries() -> dict:
    return {
        "chunk_floor": chunk_query(False), "chunk_keep_tail": chunk_query(True), "file_totals": file_totals, "chunk_summary": chunk_summary,
        "pitch_augment_rows": pitch_augment_rows, "mix_aligned_subset": mix_aligned(0.5, 0), "mix_aligned_legacy": mix_aligned(0.5, 1),
        "mix_random_background": mix_random_background, "alignment_parse": alignment_parse, "phone_counts": phone_counts,
        "phone_counts_by_sample": phone_counts_by_sample, "phone_safe_name": phone_safe_name, "interp_to_length": interp_to_length,
        "min_timeframe": extreme_timeframe(True), "max_timeframe": extreme_timeframe(False), "amplitude_scale": amplitude_scale,
        "stft_magnitude": stft_magnitude, "mel_power": _kernel(_mel, 1e4), "mfcc": _kernel(_mfcc, 1e3), "chroma": _kernel(_chroma, 1e4),
        "already_done_anti": already_done_anti, "class_distinct": class_distinct, "flatten_union": flatten_union,
        "first_three_files": first_three_files, "shuffle_paired": shuffle_paired, "kmeans_assign": kmeans_assign, "cluster_subset": cluster_subset,
        "kmeans_step": kmeans_step, "wav_files": wav_files, "npz_archives": npz_archives, "feature_table": feature_table,
        "kmeans_fit": kmeans_fit, "analysis_frame": analysis_frame, "pca_project": pca_project, "pitch_shift": pitch_shift,
        "time_stretch": time_stretch, "constant_timeframe": constant_timeframe, "mel_to_audio_mix": mel_to_audio_mix,
    }


# --- DuckDB ---------------------------------------------------------------


def _int(x, scale):
    return f"CAST(floor(({x}) * {float(scale)!r}::DOUBLE + 0.5::DOUBLE) AS BIGINT)"


def _md5(purpose, key):
    return f"md5('{SEED}:{purpose}:' || ({key})::VARCHAR)"


def _draw(purpose, key):
    return f"('0x' || substr({_md5(purpose, key)}, 1, 8))::BIGINT"


def _constants(name, columns, rows):
    return f"{name}({columns}) AS (VALUES {', '.join('(' + ', '.join(repr(float(x)) + '::DOUBLE' if isinstance(x, float) else str(x) for x in r) + ')' for r in rows)})"


@lru_cache
def _spectrum() -> str:
    """CTEs up to s(vec_id, f, b, re, im): the transform by its definition."""
    return f"""y AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, unnest(range(len(embedding))) AS t FROM embeddings),
fr AS (SELECT unnest(range(0, {(64 - N_FFT) // HOP + 1})) AS f), bins AS (SELECT unnest(range(0, {N_FFT // 2 + 1})) AS b),
w AS (SELECT vec_id, f, t - f * {HOP} AS k, v * (0.5::DOUBLE - 0.5::DOUBLE * cos(2 * pi() * (t - f * {HOP}) / {N_FFT})) AS v FROM y JOIN fr ON t >= f * {HOP} AND t < f * {HOP} + {N_FFT}),
s AS (SELECT vec_id, f, b, sum(v * cos(2 * pi() * k * b / {N_FFT})) AS re, sum(v * sin(2 * pi() * k * b / {N_FFT})) AS im FROM w, bins GROUP BY ALL)"""


def _banked(name, bank) -> str:
    rows = [(j, b, float(bank[j, b])) for j in range(bank.shape[0]) for b in range(bank.shape[1])]
    return f"{_constants(name, 'j, b, c', rows)}, p AS (SELECT vec_id, f, j, sum(c * (re * re + im * im)) AS v FROM s JOIN {name} USING (b) GROUP BY ALL)"


def oracle_sql() -> dict:
    size = int(RATE * SECONDS)
    rec = "r AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS k, value::FLOAT::DOUBLE AS v, count(*) OVER (PARTITION BY user_id) AS n FROM events)"
    chunked = lambda where: f"WITH {rec} SELECT user_id, (k // {size})::BIGINT AS chunk_idx, count(*)::BIGINT AS n, sum({_int('v', 1e3)})::BIGINT AS total FROM r {where} GROUP BY 1, 2"
    ab = "a AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS i, vec_id, embedding AS y FROM embeddings WHERE label = 5), b AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS i, vec_id, embedding AS y FROM embeddings WHERE label = 6)"
    mean = _int("((x::DOUBLE + z::DOUBLE) / 2)::FLOAT::DOUBLE", 1e5)

    def aligned(start):
        return f"""WITH {ab}, c AS (SELECT floor(least((SELECT count(*) FROM a), (SELECT count(*) FROM b)) * 0.5::DOUBLE) AS k),
m AS (SELECT a.i, row_number() OVER (ORDER BY {_md5('aligned', 'a.i')}, a.i) AS rk, a.y AS ya, b.y AS yb FROM a JOIN b ON a.i = b.i WHERE a.i >= {start}),
u AS (SELECT i, rk, unnest(range(len(ya)))::INTEGER AS k, unnest(ya) AS x, unnest(yb) AS z FROM m, c WHERE rk <= c.k)
SELECT i, rk, k, {mean} AS v FROM u"""

    def timeframe(which):
        return f"""WITH {rec}, t AS (SELECT {which}(n) AS m FROM r), j AS (SELECT unnest(range(0, m)) AS j, m FROM t), l AS (SELECT DISTINCT user_id, n FROM r),
p AS (SELECT user_id, j, n, CASE WHEN m = 1 OR n = 1 THEN 0.0::DOUBLE ELSE j::DOUBLE * (n - 1)::DOUBLE / (m - 1)::DOUBLE END AS place FROM l, j),
q AS (SELECT *, greatest(least(floor(place)::BIGINT, n - 2), 0) AS lo FROM p)
SELECT q.user_id, q.j::INTEGER AS k, {_int("a.v + (place - lo) * (coalesce(b.v, a.v) - a.v)", 1e3)} AS v FROM q JOIN r a ON a.user_id = q.user_id AND a.k = q.lo LEFT JOIN r b ON b.user_id = q.user_id AND b.k = q.lo + 1"""

    values = "CASE event_id % 5 " + " ".join(f"WHEN {k} THEN '{names.SAFE_NAMES.get(p, p)}'" for k, p in enumerate(PHONES)) + " END"
    named = lambda of: f"CASE event_id % {len(PHONES) + 1} " + " ".join(f"WHEN {k} THEN '{of(p)}'" for k, p in enumerate((*PHONES, ""))) + " END"
    labels, safe = named(str), named(lambda p: names.SAFE_NAMES.get(p, p))
    flat_bins = f"(f * {{w}} + {{j}})::INTEGER AS k"
    log = "10 * log10(greatest(v, 1e-10::DOUBLE))"
    dct = [(i, j, float(x)) for i, row in enumerate(spectral.dct_matrix(COEFFICIENTS, MELS)) for j, x in enumerate(row)]
    nearest = "list_sum(list_transform(range(1, len(e.embedding) + 1), lambda q: (e.embedding[q]::DOUBLE - c.embedding[q]::DOUBLE) * (e.embedding[q]::DOUBLE - c.embedding[q]::DOUBLE)))"
    assigned = f"d AS (SELECT e.vec_id, c.vec_id AS cl, row_number() OVER (PARTITION BY e.vec_id ORDER BY {nearest}, c.vec_id) AS k FROM embeddings e, (SELECT * FROM embeddings WHERE vec_id < 6) c)"
    return {
        "chunk_floor": chunked(f"WHERE k < n // {size} * {size}"),
        "chunk_keep_tail": chunked(""),
        "file_totals": f"SELECT user_id, {_int(f'count(*) / {RATE}::DOUBLE', 1e3)} AS ms, floor(count(*) / {RATE}::DOUBLE / {SECONDS}::DOUBLE)::BIGINT AS num_chunks FROM events GROUP BY user_id",
        "chunk_summary": f"WITH t AS (SELECT count(*) / {RATE}::DOUBLE AS d FROM events GROUP BY user_id) SELECT sum(floor(d / {SECONDS}::DOUBLE))::BIGINT AS chunks, {_int('sum(d)', 1e3)} AS ms FROM t",
        "pitch_augment_rows": f"SELECT vec_id, v AS variant, CASE WHEN v = 1 THEN -6 + {_draw('pitch', 'vec_id')} % 13 END AS steps, vec_id * 2 + v AS ord FROM embeddings, (VALUES (0::BIGINT), (1::BIGINT)) t(v)",
        "mix_aligned_subset": aligned(0),
        "mix_aligned_legacy": aligned(1),
        "mix_random_background": f"""WITH {ab}, p AS (SELECT a.vec_id AS fg, a.y AS ya, {_draw('background', 'a.vec_id')} % (SELECT count(*) FROM b) AS g FROM a),
u AS (SELECT fg, b.vec_id AS bg, unnest(range(len(ya)))::INTEGER AS k, unnest(ya) AS x, unnest(b.y) AS z FROM p JOIN b ON b.i = p.g)
SELECT fg, bg, 'mask' AS label, k, {mean} AS v FROM u""",
        "alignment_parse": "SELECT user_id, row_number() OVER w - 1 AS ord, CASE WHEN event_id % 7 = 0 THEN '' ELSE event_type END AS phone, (row_number() OVER w - 1)::DOUBLE AS t0, (row_number() OVER w)::DOUBLE AS t1 FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)",
        "phone_counts": "SELECT event_type AS phone, count(*) AS n FROM events WHERE value / 1000.0::DOUBLE > 0.02::DOUBLE GROUP BY 1",
        "phone_counts_by_sample": "SELECT user_id AS sample_id, event_type AS phone, count(*) AS n FROM events WHERE value / 1000.0::DOUBLE > 0.02::DOUBLE GROUP BY 1, 2",
        "phone_safe_name": f"SELECT event_id, {values} AS safe_name FROM events",
        "interp_to_length": f"""WITH p AS (SELECT vec_id, embedding AS y, unnest(range(0, 100)) AS j FROM embeddings), q AS (SELECT *, j::DOUBLE * 63::DOUBLE / 99::DOUBLE AS place FROM p), o AS (SELECT *, least(floor(place)::INTEGER, 62) AS lo FROM q)
SELECT vec_id, j::INTEGER AS k, {_int('y[lo + 1]::DOUBLE + (place - lo) * (y[lo + 2]::DOUBLE - y[lo + 1]::DOUBLE)', 1e5)} AS v FROM o""",
        "min_timeframe": timeframe("min"),
        "max_timeframe": timeframe("max"),
        "amplitude_scale": f"SELECT vec_id, k::INTEGER AS k, {_int('x::DOUBLE * 0.5::DOUBLE', 1e5)} AS v FROM (SELECT vec_id, unnest(range(len(embedding))) AS k, unnest(embedding) AS x FROM embeddings)",
        "stft_magnitude": f"WITH {_spectrum()} SELECT vec_id, {flat_bins.format(w=N_FFT // 2 + 1, j='b')}, {_int('sqrt(re * re + im * im)', 1e4)} AS v FROM s",
        "mel_power": f"WITH {_spectrum()}, {_banked('bank', spectral.mel_bank(TOY_SR, N_FFT, MELS))} SELECT vec_id, {flat_bins.format(w=MELS, j='j')}, {_int('v', 1e4)} AS v FROM p",
        "mfcc": f"""WITH {_spectrum()}, {_banked('bank', spectral.mel_bank(TOY_SR, N_FFT, MELS))}, {_constants('dct', 'i, j, c', dct)},
l AS (SELECT vec_id, f, j, greatest({log}, max({log}) OVER (PARTITION BY vec_id) - 80) AS v FROM p), m AS (SELECT vec_id, f, i, sum(c * v) AS v FROM l JOIN dct USING (j) GROUP BY ALL)
SELECT vec_id, {flat_bins.format(w=COEFFICIENTS, j='i')}, {_int('v', 1e3)} AS v FROM m""",
        "chroma": f"""WITH {_spectrum()}, {_banked('bank', spectral.chroma_bank(2048, N_FFT, PITCHES))}, m AS (SELECT *, max(v) OVER (PARTITION BY vec_id, f) AS top FROM p)
SELECT vec_id, {flat_bins.format(w=PITCHES, j='j')}, {_int('v / CASE WHEN top > 1e-12::DOUBLE THEN top ELSE 1 END', 1e4)} AS v FROM m""",
        "already_done_anti": "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
        "class_distinct": "SELECT DISTINCT label FROM embeddings",
        "flatten_union": "SELECT label::INTEGER AS class, vec_id FROM embeddings WHERE label IN (5, 6)",
        "first_three_files": "SELECT label, vec_id FROM embeddings WHERE label IN (SELECT DISTINCT label FROM embeddings ORDER BY label LIMIT 3)",
        "shuffle_paired": f"SELECT vec_id, label, row_number() OVER (ORDER BY {_md5('shuffle', 'vec_id')}, vec_id) AS place FROM embeddings",
        "kmeans_assign": f"WITH {assigned} SELECT vec_id, cl::INTEGER AS cluster FROM d WHERE k = 1",
        "cluster_subset": f"WITH {assigned} SELECT vec_id FROM d WHERE k = 1 AND cl = 0",
        "kmeans_step": f"""WITH {assigned}, m AS (SELECT cl, unnest(range(len(embedding)))::INTEGER AS k, unnest(embedding)::DOUBLE AS v FROM d JOIN embeddings USING (vec_id) WHERE d.k = 1)
SELECT cl::INTEGER AS cluster, count(*) AS n, k, {_int('avg(v)', 1e5)} AS v FROM m GROUP BY cl, k""",
        "constant_timeframe": "SELECT vec_id, round(len(embedding) / (0.75::DOUBLE * len(embedding) / 22050))::BIGINT AS n FROM embeddings",
        "wav_files": f"""WITH {rec}, o AS (SELECT user_id, row_number() OVER (ORDER BY lpad(user_id::VARCHAR, 9, '0')) - 1 AS file_ord FROM (SELECT DISTINCT user_id FROM events))
SELECT user_id, file_ord, {WAV_RATE}::INTEGER AS sr, k::INTEGER AS k, round_even(least(v, 1000::DOUBLE) / 1000 * 32767, 0)::BIGINT AS v FROM r JOIN o USING (user_id)""",
        "npz_archives": f"""WITH a AS (SELECT label, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS arr_idx, embedding FROM embeddings),
u AS (SELECT label, arr_idx, unnest(range(len(embedding))) AS k, unnest(embedding)::DOUBLE AS v FROM a)
SELECT label::INTEGER AS label, arr_idx::INTEGER AS arr_idx, 8::INTEGER AS width, k::INTEGER AS k, {_int('v', 1e5)} AS v FROM u""",
        "feature_table": f"SELECT label, CASE WHEN label = '' THEN '_empty' ELSE safe END AS safe_name, count(*) AS n, sum(event_id)::BIGINT AS total FROM (SELECT event_id, {labels} AS label, {safe} AS safe FROM events) GROUP BY ALL",
    }


__all__ = ["digest", "flagship", "oracle_sql", "queries"]
