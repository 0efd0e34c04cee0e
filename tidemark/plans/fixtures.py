"""Small fixed inputs for branches that the generated tables can't reach."""

from __future__ import annotations

import hashlib
import json


def literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    if isinstance(value, list):
        return "[" + ", ".join(map(literal, value)) + "]"
    return str(value)


def values(rows: list[tuple], names: str) -> str:
    """The rows as a SQL table expression t(names)."""
    return "(VALUES " + ", ".join("(" + ", ".join(map(literal, r)) + ")" for r in rows) + f") AS t({names})"


def rolling_cues() -> list[tuple[int, int, str]]:
    """Cue sequences (seq, i, text) that roll on by a few words, with case changes, punctuation and one long overlap."""
    words = [f"w{k}" for k in range(90)]
    out = []
    for seq in range(12):
        step, size = seq % 5 + 1, 4 + seq % 7
        for i in range(9):
            part = words[i * step : i * step + size]
            if seq % 3 == 1:
                part = [w.upper() if k % 2 else f"{w}," for k, w in enumerate(part)]
            out.append((seq, i, " ".join(part)))
    long = [f"x{k}" for k in range(60)]
    extra = {20: [" ".join(long), " ".join(long[5:] + ["end"])], 21: ["a b -- !", "-- ! c d"], 22: ["Straße am See", "STRASSE AM SEE", "am See weiter"], 23: ["one two three", "three four"], 24: ["x y", "", "x y z"], 25: ["go on and", "And on we", "on   we  go"]}
    extra[26] = [" ".join(long[:45]), " ".join(long[4:45] + ["tail"])]
    for seq, texts in extra.items():
        out += [(seq, i, t) for i, t in enumerate(texts)]
    return out


ID = "abcDEF123_-"
URLS = [
    f"https://www.youtube.com/watch?v={ID}&index=2",
    f"https://www.youtube.com/shorts/{ID}?si=q7",
    f"https://youtu.be/{ID}?start=9",
    f"  https://M.YouTube.com./watch?v={ID}  ",
    f"https://youtube.com/watch?v=&v={ID}",
    "https://youtube.com/watch?v=abc%44EF123_-",
    f"https://www.youtube.com:443/SHORTS/{ID}/",
    f"https://www.youtube.com:0443/watch?v={ID}",
    f"https://www.youtube.com:/watch?v={ID}",
    f"https://youtu.be//{ID}/more/",
    f"https://@youtu.be/{ID}",
    f"https://user:pw@youtu.be/{ID}",
    f"https://youtu.be:8443/{ID}",
    f"http://youtu.be/{ID}",
    "https://www.youtube.com/feed/trending",
    "https://www.youtube.com/@someone/videos",
    "https://www.youtube.com/playlist?list=PL0",
    f"https://www.youtube.com/watch/?v={ID}",
    f"https://www.youtube.com/watch?v={ID}x",
    f"https://example.com/watch?v={ID}",
    "",
    None,
]

TRACKS = [
    ("auto-manual", ["nl-BE"], ["nl-BE"], "auto"),
    ("auto-language-first", ["nl-BE", "sv"], ["en-NZ"], "auto"),
    ("auto-other-kind-first", ["zz"], ["aa"], "auto"),
    ("auto-family", ["en-GB", "en-AU"], [], "auto"),
    ("exact", ["pt"], ["pt-BR", "pt"], "pt-BR"),
    ("exact-case", ["EN-us"], [], "en-US"),
    ("exact-automatic-before-family", ["de-AT"], ["de"], "de"),
    ("family", ["fr-CA"], ["fr-BE"], "fr"),
    ("family-automatic", ["es"], ["fr-BE"], "fr-FR"),
    ("to-english", ["nl"], ["en"], "fr"),
    ("to-dutch", ["de"], ["nl"], "fr"),
    ("to-other", ["pt", "de"], ["aa"], "fr"),
    ("to-other-automatic", [], ["pt", "de"], "fr"),
    ("none", [], [], "fr"),
    ("dotted", ["en.x1"], ["en"], "auto"),
]

REQUESTS = [
    '{"enabled": true, "request_id": "req-1", "url": "https://youtu.be/abcDEF123_-?start=9", "language": "nl"}',
    '{"enabled": true, "request_id": " req-2 ", "url": "https://www.youtube.com/shorts/abcDEF123_-"}',
    '{"enabled": true, "request_id": "req-3", "url": "https://www.youtube.com/watch?v=abcDEF123_-", "language": ""}',
    '{"enabled": false, "request_id": "req-4", "url": "https://youtu.be/abcDEF123_-"}',
    '{"enabled": 1, "request_id": "req-5", "url": "https://youtu.be/abcDEF123_-"}',
    '{"enabled": "true", "request_id": "req-6", "url": "https://youtu.be/abcDEF123_-"}',
    '{"request_id": "req-7", "url": "https://youtu.be/abcDEF123_-"}',
    '{"enabled": true, "request_id": "x", "url": "https://youtu.be/abcDEF123_-"}',
    '{"enabled": true, "request_id": "-bad", "url": "https://youtu.be/abcDEF123_-"}',
    '{"enabled": true, "request_id": "req-8", "url": "https://youtu.be/abcDEF123_-", "language": "two words"}',
    '{"enabled": true, "request_id": "req-9", "url": "https://youtu.be/abcDEF123_-", "language": "AUTO"}',
    '{"enabled": true, "request_id": "req-10", "url": "http://youtu.be/abcDEF123_-"}',
    '{"enabled": true, "request_id": "req-11", "url": "https://youtu.be/abcDEF123_-", "youtube": {"a": 1}, "extra": 1}',
    '{"enabled": true, "request_id": 12345, "url": "https://youtu.be/abcDEF123_-", "language": "en-US"}',
    '{"enabled": true, "request_id": "req-12"}',
    "[1, 2]",
    '"text"',
    "{broken",
]

FAILURES = ["ERROR: Sign in to confirm you’re human", "HTTP Error 403: Forbidden", "Too Many Requests", "Confirm you're NOT a bot", "network unreachable", "", None]

REPORTS = [
    (
        "a.sarif",
        '{"runs":[{"tool":{"driver":{"rules":[{"id":"r1","properties":{"security-severity":"7.0"}},{"id":"r2","properties":{"security-severity":"9.5"}},{"id":"r3","properties":{"security-severity":"6.9"}},{"id":"r4"},{"id":"r5","properties":{"security-severity":"high"}},{"id":"r2","properties":{"security-severity":"8.1"}}]}},'
        '"results":[{"ruleId":"r1","ruleIndex":0,"message":{"text":"m1"},"locations":[{"physicalLocation":{"artifactLocation":{"uri":"lib/y.sh"},"region":{"startLine":12}}}]},'
        '{"ruleId":"r2","message":{"markdown":"m2"}},{"ruleId":"r3","ruleIndex":2,"message":{"text":"m3"}},{"ruleId":"r4","ruleIndex":3},{"ruleId":"r5","ruleIndex":4},'
        '{"ruleId":"r1","ruleIndex":-1,"message":{"text":"m4"},"locations":[{"physicalLocation":{"artifactLocation":{"uri":"y.py"}}}]},{"ruleIndex":1,"message":{"text":"m5"},"locations":[]},{"ruleId":"none","ruleIndex":99}]}]}',
    ),
    ("b.sarif", '{"runs":[]}'),
    ("c.sarif", '{"runs":[{"tool":{"driver":{"rules":[{"id":"n","properties":{"security-severity":"NaN"}}]}},"results":[{"ruleId":"n","message":{}}]}]}'),
]
#: What must be found in REPORTS, by hand: path, rule_id, severity (text), location, message.
FINDINGS = [("a.sarif", "r1", "7.0", "lib/y.sh:12", "m1"), ("a.sarif", "r2", "8.1", "", "m2"), ("a.sarif", "r1", "7.0", "y.py", "m4"), ("a.sarif", "r2", "9.5", "", "m5"), ("c.sarif", "n", "NaN", "", "")]

SUBTITLES = [
    ("vtt", "a.vtt", "﻿WEBVTT\nKind: captions\n\n00:00:01.000 --> 00:00:02.000 align:start\ncalm <c>water</c>\n\n00:00:02.000 --> 00:00:03.500\ncalm water rises\n\nNOTE a comment\nhidden\n\n1:00:02.000 --> 1:00:03.500\n<00:00:01.500>a &amp;amp; b<br/>c\n"),
    ("srt", "b.srt", "1\r\n00:00:01,000 --> 00:00:02,000\r\nfirst line\r\nsecond   line\r\n\r\n2\r\n00:00:02,000 --> 00:00:03,000\r\nSecond line, third\r\n"),
    ("untimed", "c.vtt", "WEBVTT - title\n\n12\nplain text\n\nLanguage: en\nmore\n\n00:00:01.000 --> 00:00:02.000\none\n00:00:03.000 --> 00:00:04.000\ntwo"),
    ("empty", "d.vtt", "WEBVTT\n\n00:00:01.000 --> 00:00:02.000\n&nbsp;\n"),
]
#: Their segments, by hand: name, position, start, end, text.
SEGMENTS = [
    ("vtt", 0, "00:00:01.000", "00:00:02.000", "calm water"),
    ("vtt", 1, "00:00:02.000", "00:00:03.500", "rises"),
    ("vtt", 2, "1:00:02.000", "1:00:03.500", "a &amp; b c"),
    ("srt", 0, "00:00:01,000", "00:00:02,000", "first line second line"),
    ("srt", 1, "00:00:02,000", "00:00:03,000", "third"),
    ("untimed", 0, None, None, "WEBVTT - title"),
    ("untimed", 1, None, None, "plain text"),
    ("untimed", 2, "00:00:01.000", "00:00:02.000", "one 00:00:03.000 --> 00:00:04.000 two"),
]

TERMS = ["the", "worthless", "license", "password", "que", "über"]

#: Raw metadata, and by hand its usable codes and the choice for `auto`: id, manual, automatic, language, kind.
METADATA = [
    '{"subtitles": {"pt-BR": [{"url": "http://s/1"}], "it": [{"ext": "vtt"}]}, "automatic_captions": {"en-GB": [{"url": "http://s/2?tlang="}]}}',
    '{"subtitles": {"live_chat": [{"url": "u"}], "sv!": [{"url": "u"}], "fi": [], "da": ["text"], "no": null}}',
    '{"automatic_captions": {"en": [{"url": "http://s/3?a=1&tlang=en"}], "pl": [{"url": "http://s/4?tlang=pl"}, {"url": "http://s/5"}], "cs": [{"url": 7}]}}',
    '{"subtitles": {"ja": [{"url": "u"}], "ar": [{"url": "u"}]}, "automatic_captions": {"nl-BE.auto": [{"url": "u"}]}}',
    "{}",
]
TRACK_CODES = [(0, "it,pt-BR", "en-GB", "en-GB", "automatic"), (1, "", "", None, None), (2, "", "cs,pl", "cs", "automatic"), (3, "ar,ja", "nl-BE.auto", "nl-BE.auto", "automatic"), (4, "", "", None, None)]

#: Contract texts, what they must hold, and by hand what fails: id, failure.
SCALARS, BANNED, PINS = {"schema_version": "2.1", "target": "direct"}, ["owner", "truth"], {"yt-dlp": ("5.1", "aa"), "deno-ejs-runtime": ("7", "bb")}
CONTRACTS = [
    '{"schema_version": "2.1", "target": "direct", "tools": [{"id": "yt-dlp", "version": "5.1", "sha256": "aa"}, {"id": "deno-ejs-runtime", "version": "7", "sha256": "bb"}]}',
    '{"schema_version": "2.0", "truth": 1, "owner": null, "tools": [{"id": "yt-dlp", "version": "1", "sha256": "aa"}, {"id": "deno-ejs-runtime", "version": "7", "sha256": "cc"}]}',
    '{"schema_version": "2.1", "target": "direct", "tools": [{"id": "yt-dlp", "version": "5.1", "sha256": "aa"}, {"id": "other", "version": "7", "sha256": "bb"}]}',
    '{"schema_version": "2.1", "target": "direct", "tools": [{"id": "yt-dlp", "version": "0", "sha256": "x"}, {"id": "yt-dlp", "version": "5.1", "sha256": "aa"}, {"id": "deno-ejs-runtime", "version": "7", "sha256": "bb"}]}',
    '{"schema_version": "2.1", "target": "direct"}',
]
CONTRACT_FAILURES = [
    (1, "schema_version must be 2.1"), (1, "target must be direct"), (1, "project truth keys in contract: owner, truth"), (1, "yt-dlp version/hash pin mismatch"), (1, "deno-ejs-runtime version/hash pin mismatch"),
    (2, "unexpected tool set: other, yt-dlp"), (4, "unexpected tool set: "),
]

#: Whether the tool names itself, exit code, output, and by hand the version.
VERSIONS = [(False, 0, " 2031.4 \n", "2031.4"), (False, 1, "2031.4", "unknown"), (True, 0, "Deno 3.1 (stable)\nv8 9", "3.1"), (True, 0, "node 3.1", "unknown"), (True, 0, "deno", "unknown"), (True, 0, "", "unknown"), (True, 2, "deno 3.1", "unknown")]

#: Raw texts and, by hand, what cleaning leaves.
CLEANED = [
    ("<0:00:04.500>on<i>e</i> <c.x>two</c>", "one two"),
    ("up<BR/>and<br >down", "up and down"),
    ("&lt;i&gt; stays, &amp;lt; too", "<i> stays, &lt; too"),
    ("5 < 6 but 7 > 2", "5 2"),
    ("no\u00a0break\u200bs \t at  all", "no breaks at all"),
    ("  line \n\n next\t", "line next"),
    ("caf&eacute; &hellip; &#x41;&#66;&notit; &copy", "caf\u00e9 \u2026 AB\u00acit; \u00a9"),
    ("fish &amp chips & co; a&b", "fish & chips & co; a&b"),
    ("", ""),
    (None, None),
]

ENGINE = {"execution_target": "local", "yt_dlp_version": "5.1", "deno_version": "7"}


def result_text(changes: dict, engine: dict = ENGINE, body: str = "spoken words\n") -> str:
    """A valid result as JSON, with changes by path; an Ellipsis takes a key away."""
    value = {"schema_version": "2.1", "request_id": "case", "status": "ok", "source": {"url": f"https://www.youtube.com/shorts/{ID}", "video_id": ID, "type": "short"}, "caption": {"language": "nl-BE", "kind": "automatic", "format": "srt", "cue_count": 4}, "transcript_sha256": hashlib.sha256(body.encode()).hexdigest(), "transcript_chars": len(body), "runtime_provenance": dict(engine), "media_downloaded": False}
    for path, new in changes.items():
        *above, key = path.split(".")
        at = value
        for name in above:
            at = at[name]
        if new is ...:
            at.pop(key, None)
        else:
            at[key] = new
    return json.dumps(value)


_BODY = "spoken words\n"
_NONE = {"status": "skipped_no_captions", "caption": None, "transcript_sha256": None, "transcript_chars": 0}
_REFUSED = {**_NONE, "status": "access_blocked", "error": "sign in"}
#: By hand the first violated rule, the result, its transcript, and other artifacts.
RESULTS = [
    (rule, value if isinstance(value, str) else result_text(value), body, ["result.json", *more])
    for rule, value, body, more in [
        (None, {}, _BODY, ["transcript.txt", "SHA256SUMS.txt"]),
        (None, {}, "spoken words\r\n", ["transcript.txt"]),
        (None, _NONE, None, []),
        (None, _REFUSED, None, []),
        ("V0", "{not JSON", None, []),
        ("V1", {"schema_version": "3"}, _BODY, []),
        ("V2", {"status": "pending"}, None, []),
        ("V3", {"source.type": "live"}, _BODY, []),
        ("V4", {"source.video_id": ID + "x"}, _BODY, []),
        ("V5", {"source.url": f"https://www.youtube.com/watch?v={ID}"}, _BODY, []),
        ("V6", {"source_set_version": None}, _BODY, []),
        ("V7", {"media_downloaded": ...}, _BODY, []),
        ("V8", {"runtime_provenance": "local"}, _BODY, []),
        ("V9", {"runtime_provenance.execution_target": "hosted"}, _BODY, []),
        ("V10", {"runtime_provenance.yt_dlp_version": "5.2"}, _BODY, []),
        ("V11", {"runtime_provenance.deno_version": "8"}, _BODY, []),
        (None, {"runtime_provenance.execution_target": "test", "runtime_provenance.yt_dlp_version": ...}, _BODY, []),
        ("V12", {"caption": []}, _BODY, []),
        ("V13", {"caption.kind": None}, _BODY, []),
        ("V14", {"caption.language": "n"}, _BODY, []),
        ("V15", {"caption.format": "ttml"}, _BODY, []),
        ("V16", {"caption.cue_count": False}, _BODY, []),
        ("V16", {"caption.cue_count": -1}, _BODY, []),
        ("V17", {}, None, []),
        ("V18", {}, "\t\n", []),
        ("V19", {}, "other words\n", []),
        ("V20", {"transcript_chars": 12}, _BODY, []),
        ("V21", {"error": "late"}, _BODY, []),
        ("V22", _REFUSED, _BODY, []),
        ("V23", {**_NONE, "caption": {}}, None, []),
        ("V24", {**_NONE, "transcript_sha256": "0"}, None, []),
        ("V25", {**_NONE, "error": "odd"}, None, []),
        ("V26", {**_REFUSED, "error": "\n"}, None, []),
        ("V26", {**_REFUSED, "status": "error", "error": ...}, None, []),
        ("V27", {}, _BODY, ["audio/track.Opus"]),
        ("V28", {}, _BODY, ["results/result.json"]),
    ]
]
