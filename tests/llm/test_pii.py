import math
import re

from tracemill.llm import pii

from .common import SCHEMA, awkward, frame, prose, rows, seeded

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute(t):
    digits = lambda x: re.sub("[^0-9]", "", x)
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(t)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(t) if 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(t) if 10 <= len(digits(m[0])) <= 15]
    return sorted(out)


def test_base_spans_match_the_patterns():
    rng = seeded(8)
    fixed = ["a@b.com_foo@c.org x@y z@w.co@v.x", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.3.4 1.2.3", "4111 1111 1111 1111, 4111-1111-1111-1112 79927398713", "+1 (555) 123-4567. +49 (0)30 901820 +1",
             "é.ä@x.de ü4111111111111111", "+12345678901234567 1111111111111111111111", "@a.b a@@b.c a@.c -@-.-"]
    for t in [x or "" for x in awkward()] + fixed:
        assert pii.base_spans(t) == brute(t), t
    for _ in range(3000):
        t = "".join(rng.choice("a@.1+4 -(_%\n2é5") for _ in range(rng.randrange(60)))
        assert pii.base_spans(t) == brute(t), t


def test_disclosing_terms_are_found_and_removed(spark):
    rng = seeded(9)
    texts = [f"{prose(rng, 20)} Hermelinda wrote bob@example.org today {prose(rng, 20)}" for _ in range(6)]
    texts += [f"{prose(rng, 10)} wrote today {prose(rng, 10)}" for _ in range(200)] + [*awkward()]
    df = frame(spark, texts).withColumnsRenamed({"lang": "spans", "source": "tid"})
    got = rows(pii.spans(df))
    for i in range(6):
        assert [pii.KINDS[s["kind"]] for s in got[i]["spans"]] == ["term", "email"]
        s = got[i]["spans"][0]
        assert texts[i][s["start"] : s["end"]] == "Hermelinda" and s["remove"]
    assert all(not got[i]["spans"] for i in range(6, len(texts)))
    clean = pii.sanitise(df)
    assert clean.columns == df.columns
    out = rows(clean)
    assert "Hermelinda" not in out[0]["text"] and " [EMAIL] today" in out[0]["text"]
    assert all(out[i]["text"] == texts[i] for i in range(6, len(texts)))


def test_odd_rows(spark):
    assert pii.spans(frame(spark, [])).count() == 0
    data = [(None, "x@y.zz", "", "", 0), (1, "x@y.zz", "", "", 0), (1, "x@y.zz", "", "", 0), (1, "1.2.3.4", "", "", 0)]
    got = pii.spans(spark.createDataFrame(data, SCHEMA)).select("doc_id", pii.listed("spans").alias("s")).collect()
    assert sorted((r.doc_id or -1, r.s) for r in got) == [(-1, "email:0:6"), (1, "email:0:6"), (1, "email:0:6"), (1, "ip:0:7")]


def test_terms_disclose_from_afar_and_everywhere(spark):
    rng = seeded(10)
    plain = lambda n: " ".join(f"p{rng.randrange(300)}" for _ in range(n))
    texts = [f"{plain(20)} Ann {plain(30)} bob@example.org {plain(9)} (ann)" for _ in range(6)]
    texts += [f"{plain(5)} é Ann, {plain(5)}"] + [plain(40) for _ in range(200)]
    df = frame(spark, texts)
    got = rows(pii.spans(df))
    for i in range(7):
        terms = [texts[i][s["start"] : s["end"]] for s in got[i]["spans"] if s["kind"] == 4]
        assert [x.lower() for x in terms if not x.startswith("p")] == ["ann"] * (2 if i < 6 else 1), i
    clean = rows(pii.sanitise(df))
    assert not any("ann" in r["text"].lower() for r in clean.values())
    assert "[EMAIL]" in clean[0]["text"]


def test_terms_of_single_texts_and_copies_stay(spark):
    texts = ["Zoe wrote to zoe@example.org"] * 5 + ["Liz wrote to liz@example.org", "Liz wrote again"] + [f"w{i} wrote" for i in range(60)]
    assert all(s["kind"] == 0 for r in pii.spans(frame(spark, texts)).collect() for s in r.spans)


def disclosing(texts, how=pii.Disclosure()):
    """Brute force: the lower-case terms that disclose an entity, and whether they are removed."""
    edge = """!"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"""
    terms, entities = {}, {}
    for t in set(texts):
        spans = brute(t)
        entities[t] = {name for a, k, b in spans for name in pii.facets(k, t[a:b])}
        own = set()
        for m in re.finditer("[^\\x20\\x09-\\x0D]+", t):
            x = m[0].lstrip(edge)
            a = m.end() - len(x)
            x = x.rstrip(edge)
            if x and not any(a < e and a + len(x) > s for s, _, e in spans):
                own.add(x.lower())
        terms[t] = own
    total = len(entities)
    of = {e: [t for t in entities if e in entities[t]] for e in set().union(*entities.values())}
    of = {e: ts for e, ts in of.items() if how.support <= len(ts) <= total / 2**how.bits}
    beside = {x for ts in of.values() for t in ts for x in terms[t]}
    chance = math.log2(max(1, len(beside)) * max(1, len(of))) + how.surplus
    out = {}
    for e, ts in of.items():
        for x in set().union(*(terms[t] for t in ts)):
            both, held = sum(x in terms[t] for t in ts), sum(x in own for own in terms.values())
            bits = math.log2(both / held * total / len(ts)) if both else 0
            if both >= how.support and both >= how.share * held and bits >= how.bits and bits * both >= chance:
                out[x] = out.get(x, False) or both >= how.share_remove * held
    return out


def test_terms_equal_brute_force(spark):
    rng = seeded(12)
    names = [f"Name{k}" for k in range(12)]
    hosts = [f"corp{k}.example.org" for k in range(4)]
    texts = []
    for i in range(900):
        own = [f"q{rng.randrange(400)}" for _ in range(rng.randrange(5, 40))]
        if i % 4 == 0:
            k = rng.randrange(12)
            own.insert(rng.randrange(len(own)), names[k] if rng.random() < 0.8 else "nobody")
            own.insert(rng.randrange(len(own)), rng.choice([f"n{k}@{hosts[k % 4]}", f"x{i}@{hosts[k % 4]},", f"10.1.{k}.{i % 200}", f"+1 555 {k:03d} {i:04d}"]))
        elif i % 50 == 1:
            own.append(rng.choice(names))
        texts.append(" ".join(own))
    want = disclosing(texts)
    got = {}
    for r in pii.spans(frame(spark, texts)).collect():
        for s in r.spans:
            if s["kind"] == 4:
                got[texts[r.doc_id][s["start"] : s["end"]].lower()] = s["remove"]
    assert got == want and len(want) > 3


def test_generalised_classes():
    assert [pii.general(x) for x in ("Ann", "77", "a.b", "x9", "clerk")] == ["[NAME]", "[NUMBER]", "[HOST]", "[CODE]", "[TERM]"]
