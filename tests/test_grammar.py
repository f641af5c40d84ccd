import io
import json
import random

import pytest

from tracemill.sources import grammar as G
from tracemill.sources import techlog as T



def automaton(text):
    """The properties of a text, read character by character: (name, value, quoted)."""
    out, i, n = [], 0, len(text)
    while i < n:
        eq = text.find("=", i)
        if eq < 0:
            break
        name, i = text[i:eq], eq + 1
        quote = text[i] if i < n and text[i] in "'\"" else ""
        value = ""
        if quote:
            i += 1
            while i < n:
                if text[i] != quote:
                    value, i = value + text[i], i + 1
                elif text[i : i + 2] == quote * 2:
                    value, i = value + quote, i + 2
                elif quote == "'" and i + 1 < n and text[i + 1] != ",":
                    value, i = value + quote, i + 1
                else:
                    i += 1
                    break
        else:
            while i < n and text[i] != ",":
                value, i = value + text[i], i + 1
        out.append((name, value, bool(quote)))
        i += i < n and text[i] == ","
    return out


def test_properties_equal_an_automaton():
    rng = random.Random(2)
    for _ in range(4000):
        text = "".join(rng.choice(["a", "Key", "=", "=", ",", ",", "'", "'", '"', "''", '""', "7", "-1.5", " ", "\r\n", "é"]) for _ in range(rng.randrange(24)))
        assert G.properties(text) == automaton(text), text
        parsed = G.parse_event(f"41:07.120034-0090,LOAD,2,{text}\n")
        assert parsed[:4] == ("41:07.120034", "90", "LOAD", "2") and parsed[4] == automaton(text.rstrip("\r\n"))


def test_records_round_trip():
    rng = random.Random(3)
    for _ in range(500):
        props = [(rng.choice(["Alpha", "Beta", "Guid", "SearchString", "é q"]), rng.choice(["12", "-0.25", "1e9", "007", "", "x\ty", 'say "no"', "\\", "\x02", "line\r\nline"]), rng.random() < 0.5) for _ in range(rng.randrange(5))]
        record = G.to_ndjson("2031-05-06T07:41:07.120034", "90", "LOAD", rng.choice(["2", "two"]), "31050607.log", "a\\b\\31050607.log", props)
        known = json.loads(record, object_pairs_hook=list)
        assert [k for k, _ in known[:6]] == ["timestamp", "duration", "event", "level", "filename", "file_path"]
        for (name, value, quoted), (key, got) in zip(props, known[6:], strict=True):
            number = not quoted and name not in ("Guid", "SearchString") and value in ("12", "-0.25", "1e9")
            assert key == name and (float(value) == got if number else value == got)
        fixed, back = G.from_ndjson(record)
        assert fixed["duration"] == "90" and [x[:2] for x in back] == [x[:2] for x in props]


def test_headers_and_names():
    assert G.parse_event("41:07.120034-90,LOAD") is None
    assert G.parse_event("41:07.120034-90,LOAD,")[3] == "" and G.parse_event("41:07.120034-90,LOAD,k=v")[3] == "k=v"
    assert G.date_prefix("weekly.log") == "" and G.date_prefix("31990607z") == "2031-99-06T07:"
    assert G.relative_path("one.log") == "\\\\one.log" and G.relative_path("/srv/./q/one.log", "/") == "srv/q/one.log"
    assert [G.is_number(x) for x in ("-0", "3E-2", "08", "4.", "", "9" * 33)] == [True, True, False, False, False, False]
    assert G.is_event_start(b"41:07.120034-9,rest") and not G.is_event_start(b"41:07.120034-9 rest")
    for bad in ('{"timestamp":"t"}', "[2]", '{"timestamp":"","duration":1,"event":"","level":1,"filename":"","file_path":"","q":null}'):
        with pytest.raises(ValueError):
            G.from_ndjson(bad)


def test_event_starts_equal_the_expression():
    import re

    rng = random.Random(4)
    mask = re.compile(rb"^" + G.MASK.encode(), re.M)
    for _ in range(3000):
        data = b"".join(rng.choice([b"41:07.120034-90,", b"41:07.120034-", b"9,", b"\n", b"\r\n", b"x", b"41:07.12003-9,", b"0:07.120034-9,", b"41:07.120034-x,"]) for _ in range(rng.randrange(9)))
        assert G.event_starts(data) == [m.start() for m in mask.finditer(data)], data


def sample(rng):
    parts = [rng.choice([b"", T.BOM]) + rng.choice([b"", b"junk\n", b"junk"])]
    for i in range(rng.randrange(1, 9)):
        parts.append(b"%02d:%02d.%06d-%d,CALL,1,A=%s" % (i, i, i, i, rng.choice([b"x", b"'a\nb\r\n'", b"'10:00.000000-5,fake'", b"y" * 30, b""])))
        parts.append(rng.choice([b"\n", b"\r\n", b"\n\n"]))
    return b"".join(parts)


def test_ranges_equal_the_whole():
    rng = random.Random(1)
    for _ in range(60):
        data = sample(rng)
        want = [(a, b) for a, b in G.split_events(data)]
        for step in (1, 2, 3, 7, 16, 40, 1000):
            for block in (1, 5, 64):
                got = [e for s in range(0, len(data), step) for e in T.events_of(io.BytesIO(data), s, min(s + step, len(data)), block=block)]
                assert [(a, b) for a, b, _ in got] == want
                assert all(data[a:b] == body for a, b, body in got)


def test_options():
    assert T.Options.of({"path": "x", "rangeBytes": "10"}).range_bytes == 10
    for bad in ({}, {"path": "x", "nope": "1"}, {"path": "x", "idle_ms": "-1"}):
        with pytest.raises(ValueError):
            T.Options.of(bad)
