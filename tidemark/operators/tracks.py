"""Caption-track candidates and the ranked choice of one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.binding import let
from ..functions.text import fold, strip
from ..functions.urls import has_translation
from ..functions.variants import kind, text

#: Fixed value: the form of a track's language tag.
LANGUAGE_TAG = r"\A[A-Za-z]{2,3}(?:[-.][A-Za-z0-9]{2,16})*\z"
#: Families preferred where no other rule decides, best first.
FAMILIES = ("en", "nl")


def language_family(code: Column) -> Column:
    return F.split_part(F.split_part(F.replace(F.lower(code), F.lit("_"), F.lit("-")), F.lit("-"), F.lit(1)), F.lit("."), F.lit(1))


def track_codes(mapping: Column) -> Column:
    """Usable codes of a map<string,variant> from language to formats, sorted and distinct.

    Dropped are live_chat, malformed tags, codes without a format object, and codes all of whose
    formats are translations. A null map has none.
    """

    def usable(code: Column, formats: Column) -> Column:
        objects = F.filter(F.try_variant_get(formats, "$", "array<variant>"), lambda f: kind(f) == "OBJECT")
        own = F.exists(objects, lambda f: ~F.coalesce(has_translation(text(f, "$.url")), F.lit(False)))
        return (code != "live_chat") & code.rlike(LANGUAGE_TAG) & F.coalesce(own, F.lit(False))

    return F.coalesce(F.array_sort(F.array_distinct(F.map_keys(F.map_filter(mapping, usable)))), F.array().cast("array<string>"))


def track_rank(code: Column, automatic: Column, preferred: Column) -> Column:
    """2 * bucket + kind; lower is better. Buckets: the exact code, its family, en, nl, any."""
    wanted = F.lower(strip(F.coalesce(F.nullif(preferred, F.lit("")), F.lit("auto"))))
    explicit = wanted != "auto"
    family = language_family(code)
    bucket = F.when(explicit & (fold(code) == fold(wanted)), 0).when(explicit & (family == language_family(wanted)), 1)
    for k, own in enumerate(FAMILIES, 2):
        bucket = bucket.when(family == own, k)
    return 2 * bucket.otherwise(2 + len(FAMILIES)) + automatic.cast("int")


def choose_track(manual: Column, automatic: Column, preferred: Column) -> Column:
    """struct(language, kind) of the best of two code arrays, the smallest code among equals; null without a code."""

    def ranked(codes: Column, name: str) -> Column:
        return F.transform(codes, lambda c: F.struct(track_rank(c, F.lit(name == "automatic"), preferred).alias("rank"), c.alias("language"), F.lit(name).alias("kind")))

    best = F.array_min(F.concat(ranked(manual, "manual"), ranked(automatic, "automatic")))
    return let(best, lambda b: F.when(b.isNotNull(), F.struct(b["language"].alias("language"), b["kind"].alias("kind"))))


def choose_tracks(candidates: DataFrame, by: str, code_col: str = "language", kind_col: str = "kind", preferred: Column | str = "auto") -> DataFrame:
    """The best candidate row for each value of `by`: one partial aggregate, no sort and no window."""
    wanted = F.lit(preferred) if isinstance(preferred, str) else preferred
    ranked = candidates.select(F.col(by), F.struct(track_rank(F.col(code_col), F.col(kind_col) == "automatic", wanted).alias("rank"), F.col(code_col).alias("language"), F.col(kind_col).alias("kind")).alias("best"))
    return ranked.groupBy(by).agg(F.min("best").alias("best")).select(by, "best.language", "best.kind")
