import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import mpegts as m


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=3000), st.sampled_from([64, 162, 163, 183, 184, 185, 1000]))
def test_round_trip(payload, unit):
    stored = m.to_transport_stream(payload, unit)
    s = m.read_transport_stream(stored)
    assert s.payload == payload and len(stored) % 188 == 0 and s.continuity_errors == 0
    if payload:
        assert s.programs == {1: m.PMT_PID} and s.streams == {m.DATA_PID: m.PRIVATE_DATA}
        assert [u[2] for u in s.units] == [len(payload[k : k + unit]) for k in range(0, len(payload), unit)]
        assert all(u[5] and u[3] == u[4] == u[1] * 90_000 // 8000 for u in s.units)


def test_crc_of_a_known_string():
    assert m.crc32_mpeg(b"123456789") == 0x0376E6E7


def test_timestamps_wrap_at_33_bits():
    for pts in (0, 1, 0x7FFF, 1 << 29, m.CLOCK_MASK):
        packets = m._unit_packets(np.zeros(64, np.uint8), pts, 0, 0)
        assert m.read_transport_stream(packets.tobytes()).units[0][3:5] == (pts, pts)


def test_damage_is_seen():
    stored = bytearray(m.to_transport_stream(bytes(range(256)) * 100))
    whole = m.read_transport_stream(bytes(stored))
    lost = m.to_transport_stream(bytes(1000), 64)
    rows = np.frombuffer(lost, np.uint8).reshape(-1, 188)
    assert m.read_transport_stream(np.delete(rows, slice(3, 6), axis=0).tobytes()).continuity_errors == 3
    twice = np.insert(rows, 2, rows[2], axis=0)
    again = m.read_transport_stream(twice.tobytes())
    assert (again.duplicates, again.continuity_errors, again.payload) == (1, 0, bytes(1000))
    assert whole.packets == len(stored) // 188
    stored[0] = 0
    with pytest.raises(ValueError, match="sync"):
        m.read_transport_stream(bytes(stored))
    stored[0] = 0x47
    stored[12] ^= 1
    with pytest.raises(ValueError, match="table"):
        m.read_transport_stream(bytes(stored))
    with pytest.raises(ValueError, match="whole"):
        m.read_transport_stream(b"G")


def test_tables(spark):
    rows = [(1, "abc", b"x"), (1, "abc", b"y"), (None, None, None), (2, "", None), (3, "é" * 40_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, media binary")
    got = m.decode_media(m.encode_media(docs)).collect()
    key = lambda i, t: (str(i), t or "")
    want = {}
    for i, t, _ in rows:
        raw = (t or "").encode()
        padded = raw + bytes(-len(raw) % 64 if raw else 64)
        want[key(i, t)] = (len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:]))
    found = [(r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in got]
    assert sorted(found) == sorted(want[key(i, t)] for i, t, _ in rows)
    assert all(r.units[0].random_access for r in got) and m.encode_media(docs.limit(0)).count() == 0


def test_damaged_streams_are_rows_with_an_error(spark):
    whole = m.to_transport_stream(b"abc" * 100)
    rng = np.random.default_rng(4)
    broken = [b"G", whole[:-188], b"\0" + whole[1:], whole[:188 * 2]]
    for _ in range(300):
        bad = bytearray(whole)
        for at in rng.integers(0, len(bad), rng.integers(1, 6)):
            bad[at] = rng.integers(0, 256)
        broken.append(bytes(bad))
    rows = [(k, 300, s) for k, s in enumerate([whole, None, *broken])]
    got = {r.doc_id: r for r in m.decode_media(spark.createDataFrame(rows, "doc_id long, n_bytes long, media binary")).collect()}
    assert got[0].error is None and got[0].payload_sha256 == hashlib.sha256(b"abc" * 100).hexdigest() and got[1].n_packets == 0
    assert "whole packets" in got[2].error and "sync" in got[4].error
    for k, _, s in rows[2:]:
        assert got[k].media_sha256 == hashlib.sha256(s).hexdigest() and (got[k].error is None) == (got[k].payload_sha256 is not None)
