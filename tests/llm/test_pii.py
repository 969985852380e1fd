import hashlib
import random
import re

from strandloom.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else (int(c) * 2 - 9 if int(c) > 4 else int(c) * 2) for i, c in enumerate(reversed(d))) % 10 == 0


def base_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), rank, kind, m.end()))
    return sorted(out)


def texts():
    rng = random.Random(5)
    bits = ["a.b", "@", "mail.example.com", ".", " ", "1", "255", "300", "0007", "-", "4111111111111111", "4111 1111 1111 1111", "+1 (017) 555-7713", "é", "😀", "x_y", "\n", "(", ")", "+", "token = ", "a" * 40, "12.34.56.78"]
    out = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(250)]
    out += [None, "", "a" * 50_000, "1" * 50_000, "1." * 5_000, "a.b@c.d_x@e.f", "+1" * 2_000, "mail me: q@w.e " * 300, "@" * 2000]
    out += ["IBAN DE89370400440532013000 and DE88370400440532013000", "ssn 123-45-6789 or 123-45-6789", "token = 0123456789abcdef0123456789abcdef", "7536784127813050 4111111111111111"]
    return out


def test_base_spans_and_counts(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, spans string")
    for r in pii.report(df).collect():
        want = base_spans(rows[r.doc_id][1])
        text = ",".join(f"{k}:{a}:{b}" for a, _, k, b in want)
        base = [s for s in r.spans.split(",") if s.split(":")[0] in PATTERNS]
        assert ",".join(base) == text, (rows[r.doc_id], text, r.spans)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == x for _, _, k, _ in want) for x in PATTERNS)


def test_method_adds_confirmed_spans(spark):
    df = spark.createDataFrame([(1, texts()[-4]), (2, texts()[-3]), (3, texts()[-2]), (4, texts()[-1]), (5, "123-45-6789 " + "x" * 60)], "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.report(df).collect()}
    assert got[1] == "iban:5:27"
    assert got[2].split(",")[0] == "ssn:4:15" and got[5] == ""
    assert got[3] == "secret:8:40"
    assert got[4] == "pan:0:16,pan:17:33"


def test_redact(spark):
    df = spark.createDataFrame([(1, "Mail é@x a.b@c.de, call +1 (017) 555-7713!"), (2, None), (3, "clean")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert got == {1: "Mail é@x [EMAIL], call [PHONE]!", 2: None, 3: "clean"}


def test_empty_table(spark):
    assert pii.report(spark.createDataFrame([], "doc_id long, text string")).collect() == []
