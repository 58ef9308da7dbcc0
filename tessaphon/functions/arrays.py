"""Array arithmetic without UDFs."""

from pyspark.sql import functions as F


def average(a, b):
    """(a + b) / 2 by element, in FLOAT; arrays of one element stretch, other lengths must agree."""
    half = lambda x, y: ((x.cast("double") + y.cast("double")) / 2).cast("float")
    one = lambda x, y: F.transform(y, lambda v: half(F.get(x, 0), v))
    same = F.zip_with(a, b, half)
    wrong = F.raise_error(F.concat(F.lit("lengths differ: "), F.size(a).cast("string"), F.lit(" and "), F.size(b).cast("string"))).cast("array<float>")
    return F.when(F.size(a) == F.size(b), same).when(F.size(a) == 1, one(a, b)).when(F.size(b) == 1, one(b, a)).otherwise(wrong)


def scale(y, factor: float):
    return F.transform(y, lambda v: v * F.lit(float(factor)))


def interpolate(y, length):
    """Linear interpolation to ``length`` points with both ends kept."""
    n = F.size(y)
    length = F.lit(length) if isinstance(length, int) else length
    last, steps = (n - 1).cast("double"), (length - 1).cast("double")

    def point(j):
        at = j.cast("double") * last / steps
        low = F.least(F.floor(at).cast("int"), n - 2)
        a, b = F.get(y, low).cast("double"), F.get(y, low + 1).cast("double")
        return a + (at - low) * (b - a)

    first = F.get(y, 0).cast("double")
    flat = F.array_repeat(first, length)
    return F.when(n == 0, F.array().cast("array<double>")).when((length == 1) | (n == 1), flat).otherwise(F.transform(F.sequence(F.lit(0), length - 1), point))


def tone(frequency: float = 220.0, seconds: float = 5.0, sr: int = 22050, amplitude: float = 0.5):
    """Samples of a sine."""
    n = int(seconds * sr)
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: (amplitude * F.sin(2 * F.pi() * frequency * i / sr)).cast("float"))


def chunk_count(samples, sr, seconds: float, keep_tail: bool = False):
    """Whole chunks in so many samples (or those with the rest)."""
    chunks = samples / sr.cast("double") / F.lit(float(seconds))
    return (F.ceil(chunks) if keep_tail else F.floor(chunks)).cast("int")


def cut_chunks(y, sr, seconds: float, keep_tail: bool = False):
    """Consecutive slices of so many seconds; the rest is dropped or kept.

    A chunk starts at the sample nearest to its start in seconds, so chunks of
    a length that isn't a whole number of samples don't drift.
    """
    n = chunk_count(F.size(y), sr, seconds, keep_tail)
    at = lambda k: F.rint(k * F.lit(float(seconds)) * sr).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.slice(y, at(i) + 1, at(F.lit(1))))).otherwise(F.array().cast("array<array<float>>"))
