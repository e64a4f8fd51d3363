import hashlib
import random
import re

from cases import EN, frame, rows, sentence
from tessera.llm import op05_pii as op

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def luhn(d):
    total = 0
    for k, c in enumerate(reversed(d)):
        x = int(c) * (2 if k % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute(t):
    out = []
    for k, (kind, p) in enumerate((("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE))):
        for m in re.finditer(p, t or ""):
            d = re.sub(r"[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else False, "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), k, m.end(), kind))
    return sorted(out)


def card(rng, n=16):
    d = "4" + "".join(str(rng.randrange(10)) for _ in range(n - 2))
    return next(d + str(c) for c in range(10) if luhn(d + str(c)))


def text(rng):
    parts = []
    for _ in range(rng.randrange(12)):
        parts.append(rng.choice([sentence(rng, EN, 3), f"a{rng.randrange(99)}.b@x-{rng.randrange(9)}.org", "a@b", "x@y.zz@q.com", "é@ü.de", f"{rng.randrange(300)}.{rng.randrange(300)}.1.{rng.randrange(300)}",
                                 "1.2.3.4.5.6.7.8", card(rng), card(rng)[:4] + " " + card(rng)[4:], f"+1 (0{rng.randrange(10, 99)}) 555-{rng.randrange(1000, 9999)}", "+49 30.123-456 7 (", "+", "@", "ß漢", "4111 1111 1111 1111", "00001.002.3.4"]))
    return rng.choice([" ", "", "\n", ", "]).join(parts)


def test_base_equals_the_patterns(spark):
    rng = random.Random(5)
    data = [(i, text(rng), "en") for i in range(300)] + [(i, t, x) for i, t, x in rows() if i is None or i >= 900]
    got = op.personal_data(frame(spark, data)).collect()
    by_id = {i: t for i, t, _ in data}
    assert len(got) == len(data)
    for r in got:
        want = brute(by_id[r["doc_id"]])
        flat = [f"{kind}:{a}:{z}" for a, _, z, kind in want]
        assert r["base_sha256"] == hashlib.sha256(",".join(flat).encode()).hexdigest(), (by_id[r["doc_id"]], r)
        assert [r[f"n_{k}"] for k in op.KINDS] == [sum(w[3] == k for w in want) for k in op.KINDS]
        assert set(flat) <= set(r["spans"].split(","))


def planted(rng):
    data = [(i, f"{sentence(rng, EN, 5)} call me at: +1 (0{i % 90 + 10}) 555-{1000 + i} {sentence(rng, EN, 5)}", "en") for i in range(40)]
    data += [(100 + i, f"{sentence(rng, EN, 5)} call me at: 555-{2000 + i}-77 {sentence(rng, EN, 5)}", "en") for i in range(3)]
    return data + [(200 + i, f"{sentence(rng, EN, 4)} order no {7000000 + i} {sentence(rng, EN, 4)}", "en") for i in range(30)]


def test_trusted_contexts_find_further_identifiers(spark):
    got = {r["doc_id"]: r for r in op.personal_data(frame(spark, planted(random.Random(1)))).collect()}
    assert all(got[100 + i]["n_found"] == 1 and got[100 + i]["spans"].startswith("phone:") for i in range(3))
    assert all(got[200 + i]["n_found"] == 0 and got[200 + i]["spans"] == "" for i in range(30))


def test_redaction(spark):
    data = planted(random.Random(1)) + rows(6) + [(300, "é mail a.b@c.org now", "en"), (301, "é mail a.b@c.org now", "en")]
    df = frame(spark, data)
    out = op.redact(df)
    assert out.schema.names == df.schema.names and out.count() == len(data)
    got = {r["doc_id"]: r for r in out.collect()}
    assert got[300]["text"] == got[301]["text"] == "é mail [email] now" and got[300]["n_chars"] == 18
    assert "555" not in got[3]["text"] and "555" not in got[101]["text"] and got[205]["text"] == dict((i, t) for i, t, _ in data)[205] and got[900]["text"] is None


def test_empty_table(spark):
    assert op.personal_data(frame(spark, [])).count() == 0 and op.redact(frame(spark, [])).count() == 0
