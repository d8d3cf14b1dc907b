"""WARC archives: what is written, and what is read back from damaged files."""

import base64
import gzip
import hashlib
import random

import pytest

from sparkmart.llm import warc
from sparkmart.llm.warc import Gap, Record, Salvage
from sparkmart.llm.work import Work


def record(name: str, block: bytes, **fields: str) -> bytes:
    fields = {"WARC-Type": "resource", "WARC-Record-ID": f"<urn:{name}>", "WARC-Date": "2024-01-01T00:00:00Z", "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}"} | fields
    head = "".join(f"{k.replace('_', '-')}: {v}\r\n" for k, v in fields.items() if v)
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def ids(found) -> list[str]:
    return [x.header["warc-record-id"][5:-1] for x in found if isinstance(x, Record)]


def gaps(found) -> list[tuple]:
    return [(x.offset, x.length, x.why) for x in found if isinstance(x, Gap)]


NAMES = ["a", "b", "c", "d"]
BLOCKS = [b"first block " * 9, b"", b"a \x1f\x8b\x08 and WARC/1.1\r\n in the block\r\n\r\n", bytes(range(256)) * 300]
PARTS = [record(n, b) for n, b in zip(NAMES, BLOCKS)]


@pytest.mark.parametrize("pack", [lambda p: p, gzip.compress], ids=["plain", "gzip"])
def test_whole_files(pack):
    data = b"".join(map(pack, PARTS))
    found = list(Salvage(data))
    assert ids(found) == NAMES and not gaps(found) and [x.block for x in found] == BLOCKS
    assert [x.offset for x in found] == [sum(len(pack(p)) for p in PARTS[:i]) for i in range(4)]
    assert list(Salvage(b"")) == []
    whole = list(Salvage(gzip.compress(b"".join(PARTS))))
    assert ids(whole) == NAMES and not gaps(whole)


@pytest.mark.parametrize("pack", [lambda p: p, gzip.compress], ids=["plain", "gzip"])
@pytest.mark.parametrize("hit", range(4))
def test_later_records_are_recovered(pack, hit):
    parts = [pack(p) for p in PARTS]
    start = sum(map(len, parts[:hit]))
    left = [n for i, n in enumerate(NAMES) if i != hit]
    # noise instead of a record, half of one, a flipped byte in the middle
    for broken in (b"\x00noise\xff" * 40, parts[hit][: len(parts[hit]) // 2], _flipped(parts[hit])):
        found = list(Salvage(b"".join([*parts[:hit], broken, *parts[hit + 1 :]])))
        assert ids(found) == left
        lost = gaps(found)
        assert lost and lost[0][0] == start and sum(n for _, n, _ in lost) == len(broken) and all(why for *_, why in lost)


def _flipped(part: bytes) -> bytes:
    at = part.find(b"Record-ID") if part.startswith(b"WARC") and b"Content-Length: 0" in part else len(part) * 2 // 3
    return part[:at] + bytes([part[at] ^ 0x81]) + part[at + 1 :]


def test_checks_of_a_record():
    good = record("g", b"good")
    why = lambda part: gaps(Salvage(part + good))[0][2]
    assert why(record("x", b"abc", WARC_Block_Digest="", **{"WARC-Block-Digest": "sha1:AAAA"})) == "block digest differs"
    assert why(record("x", b"abc", **{"WARC-Payload-Digest": "md5:00"})) == "payload digest differs"
    head = b"WARC/1.1\r\nWARC-Type: x\r\nWARC-Record-ID: <urn:x>\r\nWARC-Date: 2024\r\n"
    assert why(head + b"\r\nabc\r\n\r\n") == "no content-length"
    assert why(b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n") == "no warc-type"
    assert why(head + b"no field\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n") == "malformed header field"
    assert why(head + b"Content-Length: three\r\n\r\nabc\r\n\r\n") == "malformed content-length"
    assert why(head + b"Content-Length: 900000\r\n\r\nabc\r\n\r\n") == "block is cut short"
    assert why(head + b"Content-Length: 2\r\n\r\nabc\r\n\r\n") == "record isn't closed"
    assert why(head[:-4]) == "header runs into another one"
    assert gaps(Salvage(good + b"WARC/1.1\r\nWARC-Type: x"))[0][2] == "header without an end"
    assert gaps(Salvage(gzip.compress(good)[:-9]))[0][2] == "gzip member is cut short"
    sha1 = base64.b32encode(hashlib.sha1(b"abc").digest()).decode()
    fine = record("x", b"abc", **{"WARC-Block-Digest": f"sha1:{sha1}", "WARC-Payload-Digest": "tiger:zz", "WARC-Folded": "one\r\n two"})
    (one,) = Salvage(fine + b"\r\n")
    assert one.header["warc-folded"] == "one two"
    (cut,) = Salvage(fine[:-4])  # the digest proves that the block is whole
    assert cut.block == b"abc"


def test_any_damage_costs_only_what_it_touches():
    rng = random.Random(11)
    blocks = [rng.randbytes(rng.randrange(2000)) for _ in range(30)]
    for pack in (lambda p: p, gzip.compress):
        parts = [pack(record(str(i), b)) for i, b in enumerate(blocks)]
        starts = [sum(map(len, parts[:i])) for i in range(31)]
        for _ in range(40):
            data = bytearray(b"".join(parts))
            a = rng.randrange(len(data))
            z = min(len(data), a + rng.choice([1, 3, 500]))
            kind = rng.randrange(3)
            data[a:z] = [b"", rng.randbytes(z - a), data[a:z] + rng.randbytes(7)][kind]
            touched = {str(i) for i in range(30) if starts[i] < z + (kind == 2) and a <= starts[i + 1]}
            found = list(Salvage(bytes(data)))
            assert set(map(str, range(30))) - touched <= set(ids(found))
            whole = {ids([x])[0]: x.block for x in found if isinstance(x, Record)}
            assert all(whole[str(i)] == blocks[i] for i in range(30) if str(i) not in touched)


def page_rows() -> list[tuple]:
    x, y = "x" * 100, "é" * 60
    return [
        (7, "http://a b\n\x7f/ü", x), (3, None, x), (None, "u", x), (3, "u", x), (9, "u", x), (4, "u", "x" * 99), (5, "u", "x" * 99),
        (6, "u", None), (1, "u", ""), (None, "u", y), (None, "u", y), (12, "u", "a\r\n\r\nWARC/1.1\r\nContent-Length: 0\r\n\r\n\r\n\r\nb\x00" * 9),
        (13, "u", "<p>" * 200_000),
    ]


def pages(llm, rows):
    from pyspark.sql import functions as F

    clashes = ("first", "value", "payload", "refers_to", "n", "path", "content", "_block", "gap")
    df = llm.createDataFrame(rows, "page_id long, url string, html string")
    return df.withColumns({c: F.lit("clash") for c in clashes}).repartition(3)


def test_edge_pages(llm):
    want = []
    for page_id, _, html in page_rows():
        payload = (html or "").encode()
        same = [p for p, _, h in page_rows() if (h or "").encode() == payload and p is not None]
        first = min(same, default=None) if len(payload) >= 100 else page_id
        revisit = first is not None and first != page_id
        want.append((page_id, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    got = [tuple(r) for r in warc.archive_pages(llm, pages(llm, page_rows())).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and sum(r[3] == "revisit" for r in got) == 3
    assert warc.archive_pages(llm, pages(llm, [])).count() == 0


def test_files_hold_all_of_a_page_and_damage_is_logged(llm, tmp_path):
    work = Work(llm)
    many = [(i, f"http://h/{i}", f"<p>{i}</p>" * 50) for i in range(100, 140)]
    path = f"{tmp_path}/archives"
    warc.write_archives(warc.judged(work, pages(llm, page_rows() + many)).coalesce(1), path, file_records=20)
    files = sorted((tmp_path / "archives").glob("part-*"))
    assert len(files) == 3
    rows = warc.read_archives(warc.load(llm, path)).collect()
    assert not [r for r in rows if r.gap] and len(rows) == 53
    texts = {r.record_id: r.payload.decode() for r in rows if r.record_type == "response"}
    given = {f"<urn:page:{i}>": html or "" for i, _, html in page_rows() + many if i not in (None, 7, 9)}
    assert {urn: text for urn, text in texts.items() if "none" not in urn} == given
    assert {r.target_uri for r in rows if r.record_id == "<urn:page:7>"} == {"http://a%20b%0A%7F/ü"}
    first = [r for r in rows if r.path.endswith(files[0].name)]
    lost = sorted(first, key=lambda r: r.offset)[4]
    data = bytearray(files[0].read_bytes())
    data[lost.offset + lost.length - 10] ^= 1
    (tmp_path / "damaged").mkdir()
    (tmp_path / "damaged" / "x.warc").write_bytes(data)
    (tmp_path / "damaged" / "y.warc.gz").write_bytes(b"".join(map(gzip.compress, PARTS)) + b"junk")
    again = warc.read_archives(warc.load(llm, f"{tmp_path}/damaged")).collect()
    gaps = sorted((r.path[-9:], r.offset, r.length) for r in again if r.gap)
    assert [g[0] for g in gaps] == ["ed/x.warc", "y.warc.gz"] and gaps[0][1] == lost.offset and gaps[1][2] == 4
    assert sum(r.gap is None for r in again) == len(first) - 1 + 4
