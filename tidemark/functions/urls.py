"""URL parsing and canonical form, without `parse_url`, which fails on spaces and keeps blank values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let
from .text import strip

#: Hosts of the supported site, and the one of short links.
HOSTS = ("youtube.com", "www.youtube.com", "m.youtube.com", "youtu.be")
SHORT_HOST = "youtu.be"
WHOLE = r"(?s)\A([A-Za-z][A-Za-z0-9+.\-]*):(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?\z"
AUTHORITY = r"(?s)\A([^:]*)(?::(.*))?\z"
#: Fixed value: the form of a video id.
VIDEO_ID = r"\A[A-Za-z0-9_-]{11}\z"
#: Messages that callers compare.
BAD_SITE = "url must be a direct HTTPS video or Short URL of the supported site"
BAD_AUTHORITY = "URL credentials and custom ports are not allowed"
BAD_VIDEO = "url must point to one video or Short"


def decoded(part: Column) -> Column:
    """Percent escapes and plus signs of a query part; an invalid escape leaves it as it is."""
    return F.coalesce(F.try_url_decode(part), part)


def query_values(query: Column, name: str) -> Column:
    """The non-blank decoded values of a query's parameter, in order."""
    pairs = F.filter(F.split(query, "&", -1), lambda p: F.instr(p, "=") > 0)
    named = F.filter(pairs, lambda p: (decoded(F.substring_index(p, "=", 1)) == name) & (F.substr(p, F.instr(p, "=") + 1) != ""))
    return F.transform(named, lambda p: decoded(F.substr(p, F.instr(p, "=") + 1)))


def has_translation(url: Column) -> Column:
    """Whether a track's URL asks for a translation (parameter tlang)."""
    query = F.regexp_extract(url, r"(?s)\A[^?#]*\?([^#]*)", 1)
    return F.coalesce(F.size(query_values(query, "tlang")) > 0, F.lit(False))


def canonical_url(raw: Column) -> Column:
    """struct(message, video_id, source_type, url); message is null where the URL is accepted."""
    return let(F.regexp_replace(strip(F.coalesce(raw, F.lit(""))), "[\t\r\n]", ""), lambda value: let(_parts(value), lambda p: let(_site(p), lambda q: let(_judged(p, q), _canonical))))


def _parts(value: Column) -> Column:
    part = lambda k: F.regexp_extract(value, WHOLE, k)
    segments = F.filter(F.split(part(3), "/", -1), lambda s: s != "")
    return F.struct(F.lower(part(1)).alias("scheme"), part(2).alias("authority"), part(3).alias("path"), part(4).alias("query"), segments.alias("segments"))


def _site(p: Column) -> Column:
    """Host, port and user part; a second @ belongs to the user part."""
    place = F.substring_index(p["authority"], "@", -1)
    user = F.substring(p["authority"], F.lit(1), F.length(p["authority"]) - F.length(place) - 1)
    host = F.regexp_replace(F.lower(F.regexp_extract(place, AUTHORITY, 1)), r"\.+\z", "")
    short = (F.size(p["segments"]) == 2) & (F.lower(F.get(p["segments"], F.lit(0))) == "shorts")
    return F.struct(host.alias("host"), F.regexp_extract(place, AUTHORITY, 2).alias("port"), F.coalesce(user, F.lit("")).alias("user"), (short & (p["path"] != "/watch") & (host != SHORT_HOST)).alias("short"))


def _judged(p: Column, q: Column) -> Column:
    video = (
        F.when(q["host"] == SHORT_HOST, F.substring_index(F.regexp_replace(p["path"], r"\A/+|/+\z", ""), "/", 1))
        .when(p["path"] == "/watch", F.get(query_values(p["query"], "v"), F.lit(0)))
        .when(q["short"], F.get(p["segments"], F.lit(1)))
    )
    good_port = (q["port"] == "") | q["port"].rlike(r"\A0*443\z")
    message = (
        F.when((p["scheme"] != "https") | ~q["host"].isin(*HOSTS), BAD_SITE)
        .when(~q["user"].isin("", ":") | ~good_port, BAD_AUTHORITY)
        .when(~F.coalesce(video, F.lit("")).rlike(VIDEO_ID), BAD_VIDEO)
    )
    return F.struct(message.alias("message"), video.alias("video"), F.when(q["short"], "short").otherwise("video").alias("kind"))


def _canonical(j: Column) -> Column:
    ok = j["message"].isNull()
    return F.struct(j["message"].alias("message"), F.when(ok, j["video"]).alias("video_id"), F.when(ok, j["kind"]).alias("source_type"), F.when(ok, site_url(j["kind"], j["video"])).alias("url"))


def site_url(kind: Column, video: Column) -> Column:
    return F.concat(F.when(kind == "short", F.lit("https://www.youtube.com/shorts/")).otherwise("https://www.youtube.com/watch?v="), video)
