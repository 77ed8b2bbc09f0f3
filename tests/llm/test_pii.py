import re
from hashlib import sha256

import numpy as np

from annoflow.llm import pii as P
from annoflow.llm.common import read


def luhn(d):
    return sum(sum(map(int, str(int(c) * 2))) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def brute(t):
    t = t or ""
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(x) <= 255 for x in m[0].split("."))]
    for kind, pattern, lo, hi in (("card", r"[0-9]([\x20-]?[0-9])+", 16, 19), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 8, 15)):
        for m in re.finditer(pattern, t):
            d = re.sub("[^0-9]", "", m[0])
            if lo <= len(d) <= hi and (kind == "phone" or luhn(d)):
                out.append((kind, m.start(), m.end()))
    return out


def check(docs):
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    got = P.digest(P.personal_data(docs)).collect()
    want = []
    for d, t in texts:
        b = brute(t)
        joined = ",".join(f"{k}:{a}:{e}" for k, a, e in b)
        want.append((d, *(sum(x[0] == k for x in b) for k in P.KINDS), sha256(joined.encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got), key=str) == sorted(want, key=str)
    return got


def test_whole_table(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    got = check(docs)
    texts = {r.doc_id: r.text for r in docs.collect()}
    secrets = {d: re.findall(r'(?i)token = "([0-9a-f]+)"', t or "") for d, t in texts.items()}
    assert sum(map(len, secrets.values())) > 5
    for r in got:
        spans = [s.split(":") for s in r.spans.split(",") if s]
        more = [texts[r.doc_id][int(a):int(b)] for k, a, b in spans if k not in P.KINDS]
        assert more == secrets[r.doc_id]


def test_patterns(spark, odd, empty):
    made = ["a.b+c@d-e.co.uk, x@y x@y.z. @a.b a@b..c", "1.2.3.4 256.1.1.1 1.2.3.4.5 01.002.3.255 0000300.1.1.1 1.2.3", "4111 1111 1111 1111 and 4111-1111-1111-1112 4111111111111111 1",
            "+1 (743) 555-3824 +12 +1-2-3-4-5-6-7-8 + 12345678 +123456789012345678", "é4111111111111111\n4111 1111\n1111 1111", "9" * 5000, "a" * 5000 + "@", "+" + "1 " * 50]
    check(spark.createDataFrame(list(enumerate(made)), "doc_id long, text string"))
    check(odd.select("doc_id", "text"))
    assert P.personal_data(odd).count() == odd.count()
    assert P.personal_data(empty).count() == 0


def test_em_finds_the_reliable_labelers():
    rng = np.random.default_rng(5)
    truth = rng.random(4000) < 0.4
    right = np.array([0.95, 0.9, 0.6, 0.9, 0.85, 0.55, 0.8])
    v = np.where(rng.random((4000, 7)) < right, truth[:, None], ~truth[:, None]).astype(int)
    v[rng.random((4000, 7)) < 0.3] = P.NONE
    patterns, counts = np.unique((v * 3 ** np.arange(7)).sum(axis=1), return_counts=True)
    prior, p = P.reliabilities(patterns, counts)
    assert abs(prior - truth.mean()) < 0.03
    got = p[1, :, P.YES] / (p[1, :, P.YES] + p[1, :, P.NO])
    assert np.abs(got - right).max() < 0.06


def test_classifier_on_held_out_spans():
    yes = ['token = "%s"' % "".join(x) for x in np.random.default_rng(6).choice(list("0123456789abcdef"), (40, 32))]
    yes += ["ssn 123-45-%04d" % i for i in range(1, 30)] + ["account DE89370400440532013000", "IBAN: GB82WEST12345698765432"]
    no = ["version 1234567890123", "page 2024-01-%02d" % 5, "on 2023-12-31 it", "isbn 9783161484100", "# 12-345-678-90"] * 10

    def spans(texts):
        return [c for t in texts for c in P.candidates(t, P.base_spans(t))]

    fit, held = spans(yes[::2] + no[::2]), spans(yes[1::2])
    keys, counts = np.unique([(c[3], c[4]) for c in fit], axis=0, return_counts=True)
    beta = P.train(keys[:, 0], keys[:, 1], counts)

    def verdict(cs):
        return P._features(np.array([c[3] for c in cs]), np.array([c[4] for c in cs])) @ beta >= 0

    assert verdict(held).mean() > 0.95
    assert verdict(spans(no[1::2])).mean() < 0.05


def test_long_lines_take_time_in_proportion():
    import time

    for line in ("1" * 1_000_000, "a" * 1_000_000, "1." * 500_000, "a@" * 300_000, "Aa " * 300_000, "+1" * 500_000, "A1 " * 300_000, "x" * 500_000 + "@" + "y" * 500_000,
                 "password: " * 100_000, "12 Aa Bb " * 100_000, "GB82 WEST " * 100_000, "1-" * 500_000, "name: Aa " * 100_000):
        began = time.time()
        base = P.base_spans(line)
        P.candidates(line, base)
        assert time.time() - began < 12, line[:20]
        assert [(k, a, b) for k, a, b in P.base_spans(line[:3000])] == brute(line[:3000]) or len(line[:3000]) < 3000


def test_emails_from_their_at_sign():
    import random

    rng = random.Random(4)
    for _ in range(4000):
        t = "".join(rng.choices("ab.@-_ \n+é1", weights=(4, 3, 3, 4, 1, 1, 1, 1, 1, 1, 1), k=rng.randint(1, 30)))
        assert list(P.emails(t)) == [(m.start(), m.end()) for m in P.EMAIL.finditer(t)], t


def planted(seed):
    """Documents of one sentence each: (text, span or None, kind)."""
    import random

    rng = random.Random(seed)
    digit = lambda n: "".join(rng.choices("0123456789", k=n))
    letters = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))
    fill = lambda: " ".join(letters(rng.randint(2, 8)) for _ in range(rng.randint(0, 5)))
    cap = lambda: letters(rng.randint(4, 8)).capitalize()

    def iban():
        body = "DE" + digit(18)
        return "DE%02d" % (98 - int("".join(str(int(c, 36)) for c in body[2:] + "DE00")) % 97) + body[2:]

    out = []
    for _ in range(30):
        spaced = " ".join(re.findall(".{1,4}", iban()))
        hexa = "".join(rng.choices("0123456789abcdef", k=32))
        first, last = rng.choice(sorted(P.FIRST_NAMES)), cap()
        first3 = digit(3)
        for text, span, kind in (
                (f"call {first3}.{digit(3)}.{digit(4)} now", None, "localphone"), (f"{fill()} phone: ({first3}) {digit(3)}-{digit(4)}", None, "localphone"),
                (f"{fill()} iban {spaced}, please", spaced, "iban"), (f"konto {iban()}", None, "iban"),
                (f'{fill()} password = "{(p := letters(rng.randint(10, 20)))}"', p, "password"), (f"my password is: {(p := letters(5) + digit(3) + '!')}", p, "password"),
                (f"passport {(p := cap()[0] + digit(2) + cap()[0] + digit(2) + cap()[0] + digit(2))} of", p, "passport"),
                (f"token = {hexa}", hexa, "secret"), (f"ssn {1 + int(digit(2)):03d}-{digit(2)}-{digit(4)} {fill()}", None, "ssn"),
                (f"{fill()} by {first} {last}, who {fill()}", f"{first} {last}", "name"), (f"dear Mrs. {(p := cap())}, {fill()}", p, "name"),
                (f"customer: {(p := cap() + ' ' + cap())}; {fill()}", p, "name"),
                (f"she lives at {(p := str(rng.randint(1, 999)) + ' ' + cap() + ' Street')}, {fill()}", p, "address"),
                (f"wohnhaft {(p := cap() + 'straße ' + str(rng.randint(1, 99)))} {fill()}", p, "address"),
                (f"{fill()} {(p := str(rng.randint(1, 99)) + ' rue de la ' + cap())}", p, "address")):
            if span is None:
                span = re.search(r"\(?[0-9]{3}\)?[ .-]?[0-9]{3}[.-][0-9]{4}|[A-Z]{2}[0-9]{20}|[0-9]{3}-[0-9]{2}-[0-9]{4}", text)[0]
            out.append((text, span, kind))
        for text in (f"version {digit(1)}.{digit(3)}.{digit(2)} {fill()}", f"the password: required {fill()}", "passwords are stored", f"in 1999 {cap()} Street {fill()}",
                     f"{cap()} {cap()} {fill()}", f"the {first} Foundation {fill()}", f"page {digit(8)}", f"COVID{digit(2)} {fill()}", f"isbn 97{digit(11)}",
                     f"on 20{digit(2)}-01-{10 + int(digit(1))} {fill()}", f"{digit(4)} {fill()} {digit(2)}", f"password reset for {fill()}", f"at {first} {rng.choice(('Hospital', 'College'))}"):
            out.append((text, None, "none"))
    return out


def test_recall_and_precision_by_kind(spark):
    """Trained and judged on planted documents, without their labels."""
    made = planted(11)
    docs = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(made)], "doc_id long, text string")
    got = {r.doc_id: {made[r.doc_id][0][x.start:x.end] for x in r.spans} for r in P.personal_data(docs).collect()}
    for kind in sorted({k for _, _, k in made} - {"none"}):
        mine = [i for i, (_, _, k) in enumerate(made) if k == kind]
        recall = sum(made[i][1] in got[i] for i in mine) / len(mine)
        assert recall >= 0.9, (kind, recall, [made[i][0] for i in mine if made[i][1] not in got[i]][:3])
    clean = [i for i, (_, _, k) in enumerate(made) if k == "none"]
    wrong = [(made[i][0], got[i]) for i in clean if got[i]]
    assert len(wrong) <= 0.05 * len(clean), wrong[:8]
    said = sum(map(len, got.values()))
    assert sum(made[i][1] in got[i] for i in range(len(made)) if made[i][1]) / said >= 0.9
