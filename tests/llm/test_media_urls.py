"""Media sniffing on built files, and URL rules and trees."""

import gzip
import hashlib
import struct
import zlib

import numpy as np
import pytest

from lexiforge.llm import media, urls
from lexiforge.llm.boosting import BoostedTrees


def png():
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 1, 1, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"\0\0")) + chunk(b"IEND", b"")


def ogg():
    page = lambda flags, body: b"OggS\0" + bytes([flags]) + b"\0" * 8 + b"\x07\0\0\0" + b"\0" * 8 + bytes([1, len(body)]) + body
    return page(2, b"head") + page(0, b"middle") + page(4, b"end")


def tiff():
    head, strip = b"II*\0" + struct.pack("<I", 12), b"\1\2\3\4"
    entries = [(256, 3, 1, 2), (257, 3, 1, 2), (273, 4, 1, 8), (279, 4, 1, 4)]
    return head + strip + struct.pack("<H", len(entries)) + b"".join(struct.pack("<HHII", *e) for e in entries) + b"\0\0\0\0"


def box(kind, body):
    return struct.pack(">I", 8 + len(body)) + kind + body


MP3_FRAME = b"\xff\xfb\x90\x00" + b"\0" * 413  # 128 kbit/s at 44.1 kHz
EBML = b"\x1aE\xdf\xa3\x87\x42\x82\x84webm" + b"\x18\x53\x80\x67"

FILES = {
    "audio/ogg": ogg(), "image/tiff": tiff(), "audio/mpeg": b"ID3\4\0\0\0\0\0\3tag" + MP3_FRAME * 3, "video/webm": EBML + b"\x83abc",
    "image/png": png(), "image/gif": b"GIF89a\x01\0\x01\0\x80\0\0\0\0\0\xff\xff\xff,\0\0\0\0\x01\0\x01\0\0\x02\x02D\x01\0;",
    "image/jpeg": b"\xff\xd8\xff\xe0\0\x04ab\xff\xda\0\x04cd\x11\x22\xff\0\x33\xff\xd9", "image/bmp": b"BM" + struct.pack("<IIIIiiHHIIiiII", 58, 0, 54, 40, 1, 1, 1, 24, 0, 4, 0, 0, 0, 0) + b"\0\0\0\0",
    "application/pdf": b"%PDF-1.4\n1 0 obj\nendobj\nstartxref\n9\n%%EOF", "application/gzip": gzip.compress(b"hello " * 100), "audio/wav": media.store_samples(b"\x80" * 64),
}


@pytest.mark.parametrize("kind", FILES)
def test_types_and_lengths(kind):
    data = FILES[kind]
    assert media.sniff(data + b"trailing")[:2] == (kind, len(data))
    for cut in (len(data) - 1, len(data) // 2):
        assert media.sniff(data[:cut])[0] == media.UNKNOWN


def test_formats_that_end_with_the_bytes():
    flac = b"fLaC\x80\0\0\x22" + b"\0" * 34 + b"\xff\xf8frame"
    mp4 = box(b"ftyp", b"isom\0\0\0\0") + box(b"moov", b"\0" * 9) + box(b"mdat", b"data")
    for kind, data in (("audio/flac", flac), ("video/mp4", mp4), ("video/webm", EBML + b"\xffabc"), ("audio/mpeg", MP3_FRAME * 3)):
        assert media.sniff(data) == (kind, len(data), []) and media.sniff(b"text" + data)[2] == [(kind, 4, len(data))]
    for bad in (flac[:20], mp4[:16], MP3_FRAME * 2, b"OggS\0\0" + ogg()[6:], b"II*\0\1\0\0\0", b"\x1aE\xdf\xa3"):
        assert media.sniff(bad)[0] == media.UNKNOWN


def test_many_magics_without_an_end():
    import time

    began = time.process_time()
    assert media.sniff(b"%PDF-1.4 " * 200_000)[0] == media.UNKNOWN
    assert time.process_time() - began < 10
    two = FILES["application/pdf"] + b" %PDF-1.5 lost " + FILES["application/pdf"]
    assert media.sniff(two)[:2] == ("application/pdf", len(FILES["application/pdf"]))


def test_carving():
    blob, want = b"junk BM RIFF ", []
    for kind, data in FILES.items():
        want.append((kind, len(blob), len(data)))
        blob += data + b" filler "
    assert media.sniff(blob) == (media.UNKNOWN, 0, want)


def test_declared_types_are_corrected(spark):
    rows = [(1, bytearray(FILES["image/png"]), "image/jpeg"), (2, bytearray(FILES["image/png"]), "IMAGE/PNG"), (3, None, "image/png"), (4, bytearray(b""), None), (6, bytearray(b"plain"), "text/plain"), (7, bytearray(b"plain"), None), (5, bytearray(FILES["image/gif"] + FILES["image/png"]), None)]
    got = {r.id: r for r in media.sniffed(spark.createDataFrame(rows, "k long, media binary, declared string"), "k", "media", "declared").collect()}
    assert (got[1].media_type, got[1].corrected, got[2].corrected, got[3].media_type, got[4].valid_bytes) == ("image/png", True, False, None, 0)
    assert (got[6].media_type, got[6].corrected, got[7].media_type) == ("text/plain", False, media.UNKNOWN)
    assert [(e["type"], e["offset"]) for e in got[5].embedded] == [("image/png", len(FILES["image/gif"]))]


def test_stored_texts_round_trip(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: r for r in media.stored_texts(docs).collect()}
    for r in docs.collect():
        raw = r.text.encode()
        payload = raw + b"\0" * (-len(raw) % 64 or (0 if raw else 64))
        x = got[r.doc_id]
        assert (x.n_bytes, x.payload_bytes, x.payload_sha256, x.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        stored = media.store_samples(payload)
        assert (x.media_bytes, x.media_sha256, x.media_type) == (len(stored), hashlib.sha256(stored).hexdigest(), "audio/wav")
        assert media.read_samples(stored)[0] == payload and x.corrected
        near = [abs(b - 128) for b in payload]
        crossings = sum((a >= 128) != (b >= 128) for a, b in zip(payload, payload[1:]))
        bins = "/".join(str(sum(b >> 5 == k for b in payload)) for k in range(8))
        assert x.feature == f"audio/wav;1x8@16000;peak={max(payload)};energy={sum(v * v for v in near)};crossings={crossings};bins={bins};embedded="


def slow_rule(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = rest
    for mark in "/?#":
        host = host.split(mark)[0]
    path = rest[len(host) :].split("?")[0].split("#")[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for says, rule in urls.RULES:
        domain, _, prefix = rule.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + prefix) and (best is None or len(rule) > len(best[1])):
            best = (says, rule)
    return host, path, best and best[1], best and best[0]


def test_rules(spark, sf):
    extra = [None, "", "no scheme", "http://ORG/", "http://a.ORG/x?y#z", "x://example.org/es/1", "x://example.org/en/12", "x://m.example.org/en/2", "http://b.com/fr/q", "http://b.com/de/q", "http://b.com/deq", "http://xorg/", "http://a.org", "http://a.org?/es/", "a://b://c.org/d", "http://É.com/de/"]
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url").union(spark.createDataFrame([(10_000 + k, u) for k, u in enumerate(extra)], "page_id long, url string"))
    source = {r.page_id: r.url for r in pages.collect()}
    for r in urls.filtered_urls(pages).collect():
        host, path, rule, says = slow_rule(source[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        if says:
            assert r.verdict == says and r.score is None
        else:
            assert r.verdict == ("block" if r.score >= 0.5 else "allow")


def test_trees_learn_held_out_urls():
    rng = np.random.default_rng(4)
    make = lambda bad: (f"http://{'x' * rng.integers(3, 9)}{rng.integers(10**6) if bad else ''}.net/{'a/' * rng.integers(1, 4)}{'?a=1&b=2&c=3' if bad and rng.random() < 0.7 else ''}",)
    parts = lambda u: (u, *slow_rule(u)[:2])
    y = rng.integers(0, 2, 1200)
    rows = [parts(make(b)[0]) for b in y]
    model = urls.UrlModel(rows[:800], y[:800].tolist())
    assert ((model.score(rows[800:]) >= 0.5) == (y[800:] == 1)).mean() > 0.9
    assert urls.UrlModel([], []).score([parts("http://a.b/")]).tolist() == [0.0]


def test_boosting_separates_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.uniform(-1, 1, (2000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.2)).astype(float)
    assert ((BoostedTrees().fit(x[:1500], y[:1500]).score(x[1500:]) > 0.5) == (y[1500:] > 0.5)).mean() > 0.93
