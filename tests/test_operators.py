"""The record and sequence operators on cases worked out by hand, and by properties on random input."""

import html
import json
import random
from html.entities import html5

import pytest
from pyspark.sql import functions as F

from tidemark.functions import text as t
from tidemark.functions.entities import decode_entities
from tidemark.functions.folding import fold
from tidemark.functions.urls import canonical_url, has_translation
from tidemark.operators import audit, cues, manifest, requests, results, sarif, status, tracks
from tidemark.plans import fixtures as fx

ID = "abcDEF123_-"


def column(spark, values, make, kind="string"):
    rows = spark.createDataFrame(list(enumerate(values)), f"i long, x {kind}")
    return [r.y for r in rows.select("i", make(F.col("x")).alias("y")).orderBy("i").collect()]


def test_clean_caption_text(spark):
    assert column(spark, [raw for raw, _ in fx.CLEANED], t.clean_caption_text) == [out for _, out in fx.CLEANED]


def test_entities_in_cues(spark):
    files = spark.createDataFrame([(1, "00:00:01.000 --> 00:00:02.000\ncaf&eacute; &#x41;&hellip;\n\n00:00:03.000 --> 00:00:04.000\n&nbsp;"), (2, "")], "i int, raw string")
    rows = {r.i: [c.text for c in r.cues] for r in cues.parse_cues(files).collect()}
    assert rows == {1: ["café A…"], 2: []}


def test_entities_equal_the_standard_library(spark):
    """Every name with and without what may follow it, numbers at all borders, and random mixtures."""
    r = random.Random(1)
    texts = [f"&{n}" for n in html5] + [f"&{n.rstrip(';')}x;y" for n in html5]
    texts += [f"x&#{n};y&#x{n:x}z" for n in [*range(300), *range(0xD7F0, 0xE010, 7), 0xFDD0, 0xFDEF, 0xFFFE, 0xFFFF, 0x10000, 0x1F600, 0x1FFFE, 0x10FFFF, 0x110000, 10**9, 10**12]]
    texts += ["", "&", "&&", "&;", "&#", "&#;", "&#x;", "a&b", "&amp;amp;", "&amp&amp", "&notit;", "&nbsp;&#X41;", "&" + "a" * 40 + ";", "&#0000065;", "&#x00000000041 ", "\n&lt\n", "&é;", "&#٣;", "&#6a;"]
    texts += ["".join(r.choices(["&", "amp", "#", "x", "1", "0", ";", " ", "lt", "gt", "not", "it", "é", "copy", "😀"], k=12)) for _ in range(2000)]
    assert column(spark, [*texts, None], decode_entities) == [*map(html.unescape, texts), None]


def test_fold_equals_the_standard_library(spark):
    """Every code point alone, inside a text, and those that the place in a word decides on."""
    points = spark.range(0x110000).where("id not between 55296 and 57343").select("id", F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32").alias("c"))
    found = points.select("id", fold(F.col("c")).alias("one"), fold(F.concat(F.lit("Aß"), "c", F.lit("Z"))).alias("inside")).where("one <> decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32') or inside <> concat('ass', decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32'), 'z')").collect()
    assert {chr(x.id): (x.one, x.inside) for x in found} == {c: (c.casefold(), f"ass{c.casefold()}z") for c in map(chr, range(0x110000)) if c.casefold() != c}
    texts = ["ΑΣ ΣΑΣ", "İIı", "STRASSE Straße ẞ", "ﬁﬂ ŉ ǰ ΐ", "ᏸᎠꭰ", "", "ὈΔΥΣΣΕΎΣ", "µ ſ K Å"]
    assert column(spark, [*texts, None], fold) == [*(x.casefold() for x in texts), None]


def keys_of(text):
    """Tokens as they are compared, by the categories of their characters."""
    import unicodedata

    return ["".join(c for c in token if c == "_" or unicodedata.category(c)[0] in "LN").lower().replace("ß", "ss") for token in text.split()]


def fits(before, line, n):
    return 2 <= n <= min(40, len(before), len(line)) and before[-n:] == line[:n]


def test_overlap_on_random_sequences(spark):
    """What is left of a line is its end; what went ends the line before, and no longer run would have done."""
    r = random.Random(4)
    words = ["a", "B", "b", "c,", "C", "--", "!", "straße", "STRASSE", "d", "e"]
    talks = []
    for _ in range(300):
        talk = [" ".join(r.choices(words, k=r.randint(1, 60)))]
        for _ in range(r.randint(0, 4)):
            last = talk[-1].split()
            talk.append(" ".join([*last[r.randint(0, len(last) - 1) :], *r.choices(words, k=r.randint(0, 5))]))
        talks.append(talk)
    rows = spark.createDataFrame(list(enumerate(talks)), "i int, texts array<string>")
    frame = rows.select("i", F.transform("texts", lambda x, k: F.struct(k.cast("string").alias("start"), F.lit(None).cast("string").alias("end"), x.alias("text"))).alias("cues"))
    found = {x.i: {int(s.start): s.text for s in x.segments} for x in cues.without_overlap(frame).collect()}
    trimmed = 0
    for i, talk in enumerate(talks):
        assert found[i][0] == talk[0]
        for k in range(1, len(talk)):
            before, line, left = keys_of(talk[k - 1]), keys_of(talk[k]), found[i].get(k, "")
            gone = len(line) - len(left.split())
            assert talk[k].split()[gone:] == left.split()
            if talk[k].lower().replace("ß", "ss") == talk[k - 1].lower().replace("ß", "ss"):
                assert left == ""
                continue
            assert gone == 0 or fits(before, line, gone)
            assert not any(fits(before, line, n) for n in range(gone + 1, 61))
            trimmed += 0 < gone < len(line)
    assert trimmed > 50
    for parts in (1, 7):
        chunked = {}
        lines = rows.select("i", F.posexplode("texts").alias("k", "text")).repartition(parts)
        for x in cues.overlap_by_chunks(lines, "i", "k", "text").collect():
            chunked.setdefault(x.i, {})[x.k] = x.residual
        assert chunked == found


def test_overlap_of_one_long_sequence(spark):
    """One sequence lies in all partitions, and every cue meets the one before, also across a border."""
    n = 20_000
    said = F.concat_ws(" ", *[F.concat(F.lit("w"), ((F.col("id") * 3 + k) % 9973).cast("string")) for k in range(7)])
    lines = spark.range(n).select(F.lit("f").alias("file"), "id", said.alias("text"), F.lit(1).alias("residual_of"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = cues.overlap_by_chunks(lines, "file", "id", "text")
        assert found.rdd.getNumPartitions() > 1
        rows = {x.id: x.residual for x in found.collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert set(rows) == set(range(n)) and len(rows[0].split()) == 7
    assert all(len(rows[k].split()) == 3 for k in range(1, n))
    assert cues.overlap_by_chunks(lines.limit(0), "file", "id", "text").count() == 0
    odd = spark.createDataFrame([(None, 1, "a b c"), (None, 2, "b c d"), ("x", 1, "c d e"), ("x", 2, None), ("x", 3, "c d e")], "file string, id int, text string")
    assert sorted((x.file or "", x.id, x.residual) for x in cues.overlap_by_chunks(odd, "file", "id", "text").collect()) == [("", 1, "a b c"), ("", 2, "d"), ("x", 1, "c d e"), ("x", 3, "c d e")]


def test_urls_from_parts(spark):
    """Whether a URL is accepted follows from the parts it is made of; what comes out comes out of itself again."""
    r = random.Random(9)
    schemes = [("https", 1), ("HTTPS", 1), ("http", 0), ("ftp", 0)]
    users = [("", 1)] * 3 + [("u@", 0), ("u:p@", 0), ("@", 1), (":@", 1)]
    ports = [("", 1)] * 2 + [(":443", 1), (":", 1), (":0443", 1), (":80", 0), (":x", 0)]
    long_host = [("youtube.com", 1), ("www.YouTube.com.", 1), ("m.youtube.com", 1), ("evil.com", 0)]
    places = [(f"/watch?v={ID}", "video"), (f"/watch?v=&v={ID}", "video"), ("/watch?v=abc%44EF123_-", "video"), (f"/watch?a=1&v={ID}&v=2", "video"), (f"/watch?%76={ID}", "video"), (f"/shorts/{ID}", "short"), (f"//SHORTS//{ID}/?x", "short"), (f"/watch/?v={ID}", None), (f"/watch?v={ID}x", None), ("/watch", None), (f"/{ID}", None), (f"/shorts/{ID}/x", None), ("", None)]
    short_places = [(f"/{ID}", "video"), (f"/{ID}/x?t=1", "video"), (f"//{ID}", "video"), (f"/watch?v={ID}", None), (f"/shorts/{ID}", None), ("", None)]
    urls, expected = [], []
    for _ in range(3000):
        host, own = r.choice([(("youtu.be", 1), short_places), (r.choice(long_host), places)])
        parts = [r.choice(schemes), ("://", 1), r.choice(users), host, r.choice(ports)]
        path, kind = r.choice(own)
        urls.append("".join(x for x, _ in parts) + path + r.choice(["", "#f"]))
        expected.append((ID, kind) if kind and all(ok for _, ok in parts) else None)
    found = column(spark, urls, canonical_url)
    assert [None if x.message else (x.video_id, x.source_type) for x in found] == expected
    good = sorted({x.url for x in found if not x.message})
    assert len(good) == 2 and [x.url for x in column(spark, good, canonical_url)] == good


def test_translation(spark):
    assert column(spark, ["https://x/y?tlang=en", "https://x/y?tlang=&a=1", "https://x/y", None, "x?a=1&tlang=nl#z"], has_translation) == [True, False, False, False, True]


@pytest.mark.parametrize(
    ("meta", "preferred", "expected"),
    [
        ({"subtitles": {"uk": [{"url": "a"}], "en-IE": [{"url": "b"}]}, "automatic_captions": {"en": [{"url": "c"}]}}, "auto", ("en-IE", "manual")),
        ({"subtitles": {"uk": [{"url": "a"}]}, "automatic_captions": {"uk-UA": [{"url": "b"}], "uk": [{"url": "c"}]}}, "UK-ua", ("uk-UA", "automatic")),
        ({"subtitles": {"live_chat": [{"url": "u"}], "english!": [{"url": "u"}], "fr": [], "de": ["text"], "es": None}}, "auto", None),
        ({}, None, None),
    ],
)
def test_track_choice(spark, meta, preferred, expected):
    rows = spark.createDataFrame([(json.dumps(meta), preferred)], "meta string, preferred string")
    rows = rows.select("preferred", F.from_json("meta", "subtitles map<string,variant>, automatic_captions map<string,variant>").alias("m"))
    track = rows.select(tracks.choose_track(tracks.track_codes(F.col("m.subtitles")), tracks.track_codes(F.col("m.automatic_captions")), F.col("preferred")).alias("t")).first().t
    assert (tuple(track) if track else None) == expected


def test_duplicate_keys_take_the_last(spark):
    value = f'{{"enabled": true, "request_id": "aaa", "request_id": "bbb", "url": "https://youtu.be/{ID}"}}'
    assert column(spark, [value, None], requests.validate_request)[0].request_id == "bbb"
    assert column(spark, [None], requests.validate_request)[0].message == "invalid JSON"


def test_failures_and_errors(spark):
    assert column(spark, fx.FAILURES, t.classify_failure) == ["access_blocked", "access_blocked", "access_blocked", "access_blocked", "error", "error", "error"]
    found = column(spark, ["access_blocked::why", "error::x::y", "odd::z", "plain", "error::" + "q" * 3000, "error"], t.split_error)
    assert [tuple(x) for x in found] == [("access_blocked", "why"), ("error", "x::y"), ("error", "odd::z"), ("error", "plain"), ("error", "q" * 2000), ("error", "")]
    rows = spark.createDataFrame([(0, "{}", "Sign in to confirm"), (0, "{}", ""), (1, "", "http error 500"), (0, "[1]", ""), (0, "x", "")], "code int, out string, err string")
    found = [r.s and r.s.status for r in rows.select(results.acquisition_status(F.col("code"), F.col("out"), F.col("err")).alias("s")).collect()]
    assert found == ["access_blocked", None, "error", "error", "error"]


def test_every_result_rule_has_a_case():
    assert {v for v, *_ in fx.RESULTS} == {None, *(f"V{k}" for k in range(29))}


def test_result_parts_are_computed_once(spark):
    """The plan parses each result once, however many rules name it."""
    rows = spark.createDataFrame([(1, "{}")], "run_id int, value string")
    found = results.validate_results(rows, spark.createDataFrame([], "run_id int, transcript string"), spark.createDataFrame([], "run_id int, rel_path string"), {})
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parse_json") + plan.count("parseJson") <= 2


def test_results_from_subtitles_to_files(spark, tmp_path):
    from tidemark.sources import files as sources

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "source.srt").write_bytes("\ufeff1\r\n00:00:01,000 --> 00:00:02,000\r\nstill water\r\n\r\n2\r\n00:00:02,000 --> 00:00:03,000\r\nstill water runs\r\n".encode())
    (tmp_path / "in" / "source.vtt").write_text("WEBVTT\n\n00:01.000 --> 00:02.000\nother")
    parsed = cues.transcripts(cues.without_overlap(cues.parse_cues(sources.read_subtitles(spark, f"file://{tmp_path}/in"))))
    best = cues.first_usable_file(parsed.withColumn("request_id", F.lit("r1")).select("request_id", "path", "transcript", "cue_count"), "request_id")
    row = best.first()
    assert (row.format, row.transcript, row.cue_count) == ("srt", "still water\nruns\n", 2)
    asked = spark.createDataFrame([("r1", "u", ID, "video", None, ("en", "manual")), ("r2", "u", ID, "video", None, None), ("r3", "u", ID, "video", ("access_blocked", "no"), None), ("r4", "u", ID, "video", None, ("en", "manual"))], "request_id string, url string, video_id string, source_type string, failure struct<status:string,error:string>, track struct<language:string,kind:string>")
    made = results.build_results(asked.join(best, "request_id", "left"))
    assert {r.request_id: r.status for r in made.collect()} == {"r1": "ok", "r2": "skipped_no_captions", "r3": "access_blocked", "r4": "error"}
    for _ in range(2):
        sources.write_results(made, f"file://{tmp_path}/out")
    assert spark.read.json(f"file://{tmp_path}/out/results").count() == 4
    assert {r.value for r in spark.read.text(f"file://{tmp_path}/out/transcripts", wholetext=True).collect()} == {"still water\nruns\n"}
    sums = manifest.manifest(sources.read_binary(spark, f"file://{tmp_path}/in"))
    assert [r.ok for r in manifest.verify(sources.read_binary(spark, f"file://{tmp_path}/in"), sums).collect()] == [True, True]


def test_sarif_findings(spark):
    found = sarif.high_findings(spark.createDataFrame(fx.REPORTS, "path string, value string")).collect()
    assert sorted((r.path, r.rule_id, str(r.security_severity).replace("nan", "NaN"), r.location, r.message) for r in found) == sorted(fx.FINDINGS)


def test_audit(spark):
    files = spark.createDataFrame([("a.py", "Uses FFmpeg here"), ("b.sh", "plain"), ("old.py", "")], "path string, text string")
    paths = lambda *x: spark.createDataFrame([(p,) for p in x], "path string")
    found = audit.audit(
        audit.missing_files(files, paths("a.py", "c.py")),
        audit.forbidden_files(files, paths("old.py", "gone.py")),
        audit.term_hits(files, spark.createDataFrame([("a.py", "ffmpeg"), ("b.sh", "ffmpeg"), ("c.py", "x")], "path string, term string")),
        audit.missing_needles(files, spark.createDataFrame([("b.sh", "pin", "no pin"), ("b.sh", "plain", "no"), ("c.py", "x", "absent")], "path string, needle string, message string")),
    )
    assert sorted(r.failure for r in found.collect()) == ["missing required file: c.py", "no pin", "obsolete file still present: old.py", "obsolete runtime term 'ffmpeg' remains in a.py"]
    assert audit.summary(found).first().failures == 4
    contract = {"schema_version": "2.1", "owner": 1, "tools": [{"id": "x", "version": "1", "sha256": "a"}, {"id": "x", "version": "2", "sha256": "b"}]}
    frame = spark.createDataFrame([(json.dumps(contract),)], "value string")
    check = lambda pins, scalars: sorted(r.failure for r in audit.contract_failures(frame, scalars, ["owner"], pins).collect())
    assert check({"x": ("2", "b")}, {"schema_version": "2.1"}) == ["project truth keys in contract: owner"]
    assert check({"x": ("1", "a")}, {"schema_version": "3"}) == ["project truth keys in contract: owner", "schema_version must be 3", "x version/hash pin mismatch"]
    assert check({"y": ("1", "a")}, {})[-1] == "unexpected tool set: x"
    assert audit.tool_versions(frame).first().versions == {"x": "2"}


def test_status(spark):
    assert column(spark, ["success", " Failure ", "pending", "cancelled", "skipped", None], status.normalize_result) == ["success", "failure", "pending", "error", "error", "error"]
    row = spark.range(1).select(status.payload(F.lit("c" * 150), F.lit("success"), F.lit("o/r"), F.lit("7")).alias("p")).first().p
    assert len(row.description) == 140 and row.target_url.endswith("/o/r/actions/runs/7")
    check = lambda *x: spark.range(1).select(status.precondition(*map(F.lit, x)).alias("m")).first().m
    assert check("c", "o/r", "a" * 40, "12", "t") is None
    assert [check(" ", "o/r", "a" * 40, "1", "t"), check("c", "o", "a" * 40, "1", "t"), check("c", "o/r", "a", "1", "t"), check("c", "o/r", "a" * 40, "x", "t"), check("c", "o/r", "a" * 40, "1", " ")] == ["context must be 1..100 characters", "repository is required", "sha must have 40 characters", "run id is required", "token is required"]


def test_tool_version(spark):
    rows = spark.createDataFrame([(0, " 2026.1 \n"), (1, "2026.1"), (0, "Deno 2.9 (x)\nv8 1"), (0, "")], "code int, out string")
    assert [r.a for r in rows.select(t.tool_version(F.col("code"), F.col("out")).alias("a")).collect()][:2] == ["2026.1", "unknown"]
    assert [r.a for r in rows.select(t.tool_version(F.col("code"), F.col("out"), "deno").alias("a")).collect()] == ["unknown", "unknown", "2.9", "unknown"]


def test_keys_and_squeezing_of_odd_spaces(spark):
    """Lines that the quick looks let pass, and such as they don't, have the keys and blanks of Python's own functions."""
    import re
    import unicodedata

    odd = t.BLANKS + "\u200b"
    texts = [f"Ab{c}Cd{c}{c}e-f,{c}ÉÜ ſs!" for c in odd] + ["  two  blanks ", "", " ", "Ümläut, ñandú; ß-Ω ж9", "́x ٠² _a", "-- !", "a < b\t\tc"]
    rows = spark.createDataFrame([(k, x) for k, x in enumerate(texts)], "k int, x string")
    for r in rows.select("x", t.token_keys(F.col("x")).alias("keys")).collect():
        assert r["keys"] == ["".join(c for c in w if c == "_" or unicodedata.category(c)[0] in "LN").casefold() for w in r["x"].split()], repr(r["x"])
    for r in rows.select("x", t.squeeze(F.col("x")).alias("s")).collect():
        plain = re.sub(r"[ \t]+", " ", r["x"].replace("\xa0", " ").replace("​", ""))
        assert r["s"] == re.sub(r"\s*\n\s*", " ", plain).strip(), repr(r["x"])
