"""WARC archives: round trip, revisits, salvage of damaged archives."""

import base64
import gzip
import hashlib
import random

from talkscout.llm import warc

PAGES = "page_id LONG, url STRING, html STRING"


def archive(n, compressed=True):
    records = [warc.build_record(i, f"http://x/{i}", (p := f"<p>{i}</p>".encode() * 50), warc.base32_sha1(p), None) for i in range(n)]
    parts = [warc.gzip_member(r) for r in records] if compressed else records
    places = [sum(map(len, parts[:i])) for i in range(n + 1)]
    return b"".join(parts), places


def ids(found):
    return [r[6] for r in found if r[3] == "record"]


def gaps(found):
    return [(r[1], r[2]) for r in found if r[3] == "gap"]


def test_members_end_in_zero():
    for size in (0, 10, 1 << 24):
        member = warc.gzip_member(b"a" * size)
        assert member[-1] == 0 and gzip.decompress(member) == b"a" * size


def test_whole_archives():
    for compressed in (True, False):
        data, _ = archive(5, compressed)
        found = warc.Salvage("x", data, True).read()
        assert ids(found) == [f"<urn:page:{i}>" for i in range(5)] and not gaps(found)
        assert found[3][-1] == b"<p>3</p>" * 50


def test_damage_costs_the_damaged_record_only():
    for compressed in (True, False):
        data, at = archive(6, compressed)
        for damage in range(6):
            for offset in (0, 3, -12, *([40] if compressed else [])):  # a plain header has no checksum
                broken = bytearray(data)
                place = (at[damage] + offset) if offset >= 0 else at[damage + 1] + offset
                broken[place] ^= 0xFF
                found = warc.Salvage("x", bytes(broken), False).read()
                left = ids(found)
                assert [i for i in range(6) if i != damage] == [i for i in range(6) if f"<urn:page:{i}>" in left and i != damage]
                if f"<urn:page:{damage}>" not in left:
                    assert gaps(found) and all(a >= at[damage] and b <= at[damage + 1] for a, b in gaps(found))


def test_truncated_and_foreign_bytes():
    data, at = archive(4)
    found = warc.Salvage("x", data[: at[3] + 20], False).read()
    assert len(ids(found)) == 3 and gaps(found) == [(at[3], at[3] + 20)]
    junk = b"\x1f\x8b\x08junk" + b"x" * 100
    found = warc.Salvage("x", data[: at[2]] + junk + data[at[2] :], False).read()
    assert len(ids(found)) == 4 and gaps(found) == [(at[2], at[2] + len(junk))]
    assert warc.Salvage("x", b"nothing here", False).read()[0][3] == "gap"
    plain, at = archive(3, False)
    found = warc.Salvage("x", b"noise" + plain, False).read()
    assert len(ids(found)) == 3 and gaps(found) == [(0, 5)]


def test_one_member_with_all_records():
    plain, _ = archive(4, False)
    whole = gzip.compress(plain)
    assert len(ids(warc.Salvage("x", whole, False).read())) == 4
    cut = warc.Salvage("x", whole[:-20], False).read()
    assert len(ids(cut)) >= 1 and gaps(cut)


def run(spark, rows, tmp_path, least=0):
    df = spark.createDataFrame(rows, PAGES).selectExpr("*", "1 AS digest", "'x' AS payload")
    folder = f"file://{tmp_path}/warc"
    warc.write_archives(df, folder, least, records_per_file=2)
    return warc.read_archives(spark, folder)


def test_round_trip(spark, tmp_path):
    rows = [
        (3, "http://a", "same"), (1, "http://b\r\nX: y", "same"), (2, None, None), (9, "u", ""), (5, "http://é", "zé" * 200_000),
        (None, "n", "null id"), (7, "r", "twice"), (7, "r", "twice"), (8, "s", "twice"),
    ]
    found = run(spark, rows, tmp_path)
    assert found.where("kind = 'gap'").count() == 0
    got = sorted((tuple(r) for r in warc.pages_of(found).collect()), key=str)
    sha = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    first = {"same": 1, "": 2, "twice": 7}
    want = []
    for page, _, html in rows:
        html = html or ""
        refers = first.get(html) if html in first and first[html] != page else None
        want.append((page, len(html.encode()), sha(html), "revisit" if refers is not None else "response", refers))
    assert got == sorted(want, key=str)
    payload = {r.record_id: bytes(r.payload) for r in found.where("record_type = 'response'").collect()}
    assert payload["<urn:page:5>"] == ("zé" * 200_000).encode()
    assert found.where("target_uri = 'http://b%0D%0AX: y'").count() == 1


def test_small_payloads_and_empty_table(spark, tmp_path):
    rows = [(1, "a", "ab"), (2, "b", "ab"), (3, "c", "abcdef"), (4, "d", "abcdef")]
    got = {r.page_id: r.refers_to for r in warc.pages_of(run(spark, rows, tmp_path, least=3)).collect()}
    assert got == {1: None, 2: None, 3: None, 4: 3}
    assert run(spark, [], tmp_path / "empty").count() == 0


def accounted(found, size):
    """Whether records and gaps cover every byte once."""
    at = 0
    for start, end in sorted({(r[1], r[2]) for r in found if r[2] > r[1]}):
        if start != at:
            return False
        at = end
    return at == size


def quoting(i, others):
    """A record whose page quotes whole records."""
    return warc.build_record(i, f"http://x/{i}", (p := b"<pre>" + b"".join(others) + b"</pre>"), warc.base32_sha1(p), None)


def test_a_quoted_record_is_never_taken_for_one():
    inner = [warc.build_record(i, "http://quoted", b"quoted", warc.base32_sha1(b"quoted"), None) for i in (98, 99)]
    good = [warc.build_record(i, f"http://x/{i}", b"page %d" % i, warc.base32_sha1(b"page %d" % i), None) for i in (0, 2)]
    for part in (b"sha1:", b"<pre>", b"HTTP/1.1 200"):  # a digest, the payload, the block
        bad = bytearray(quoting(1, inner))
        bad[bad.index(part) + len(part)] ^= 1
        plain = good[0] + bytes(bad) + good[1]
        members = [warc.gzip_member(r) for r in (good[0], bytes(bad), good[1])]
        for data, start, end in (
            (plain, len(good[0]), len(good[0]) + len(bad)),
            (b"".join(members), len(members[0]), len(members[0]) + len(members[1])),
        ):
            found = warc.Salvage("x", data, False).read()
            assert ids(found) == ["<urn:page:0>", "<urn:page:2>"] and gaps(found) == [(start, end)] and accounted(found, len(data))
        one = gzip.compress(plain, mtime=0)  # all in one member
        found = warc.Salvage("x", one, False).read()
        assert ids(found) == ["<urn:page:0>", "<urn:page:2>"] and gaps(found) == [(len(one), len(one))] and accounted(found, len(one))
    lost = quoting(1, inner).replace(b"Content-Length: ", b"Content-Length: 9", 1)  # framing lost inside a whole member
    member = warc.gzip_member(lost)
    found = warc.Salvage("x", member, False).read()
    assert ids(found) == [] and gaps(found) == [(0, len(member))]


def test_every_byte_is_accounted_for():
    rng = random.Random(8)
    for compressed in (True, False):
        data, at = archive(8, compressed)
        for _ in range(150):
            broken = bytearray(data)
            for _ in range(rng.randrange(1, 5)):
                kind, place = rng.randrange(3), rng.randrange(len(broken))
                if kind == 0:
                    broken[place] ^= 1 << rng.randrange(8)
                elif kind == 1:
                    del broken[place : place + rng.randrange(1, 300)]
                else:
                    broken[place:place] = rng.randbytes(rng.randrange(1, 300))
            found = warc.Salvage("x", bytes(broken), False).read()
            assert accounted(found, len(broken))
            assert len(ids(found)) >= 8 - 2 * 4


def test_archives_end_at_a_number_of_bytes(spark, tmp_path):
    import hashlib as h

    rows = [(i, "u", "".join(h.sha256(b"%d %d" % (i, j)).hexdigest() for j in range(2000))) for i in range(12)]
    df = spark.createDataFrame(rows, PAGES).coalesce(1)
    folder = f"file://{tmp_path}/warc"
    warc.write_archives(df, folder, bytes_per_file=150_000)
    sizes = [p.stat().st_size for p in (tmp_path / "warc").glob("*.txt")]
    assert max(sizes) < 150_000 + 80_000 and len(sizes) >= 4
    found = warc.read_archives(spark, folder)
    assert found.where("kind = 'record'").count() == 12 and found.where("kind = 'gap'").count() == 0
