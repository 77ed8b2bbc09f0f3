"""Personal data (operator 9): weak supervision over candidate spans.

Four base kinds (email, ip, card, phone) are found by fixed patterns and always stay.  Candidates for further spans come
from shapes (numbers and codes, IBANs in groups, dotted phone numbers, street addresses), from gazetteers (first names, street
words) and from contexts (what follows ``password =``, a title, ``name:``).  Regex, gazetteer and context labelers vote on each
(yes, no, abstain); expectation-maximisation estimates how reliable each labeler is from the counts of
vote patterns over all documents; the posteriors train a logistic span classifier on votes and shape,
and its verdict decides.

What leaves the tasks is a count per vote pattern and shape: at most 3 ** labelers times the shapes,
whatever the size of the corpus.
"""

from __future__ import annotations

import bisect
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from annoflow.llm.common import slices, stage

# The base patterns.
KINDS = ["email", "ip", "card", "phone"]
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: As ``[0-9]+`` and three times a dot and more; tried at the start of a row of digits only, where its leftmost match begins.
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
#: The parts of EMAIL, for a search that begins at the "@".
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Kinds the method adds, by shape.  Fixed patterns; the first that matches a candidate names it.
SHAPES = {
    "ssn": re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}"),
    "iban": re.compile(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}"),
    "localphone": re.compile(r"\(?[0-9]{3}\)?[\x20.-]?[0-9]{3}[.-][0-9]{4}"),
    "passport": re.compile(r"(?=(?:[A-Z]*[0-9]){4})[A-Z][A-Z0-9]{6,8}"),
    "secret": re.compile(r"[A-Za-z0-9_+/=-]{16,}"),
    "number": re.compile(r"[0-9][0-9-]{5,}[0-9]"),
}
CANDIDATE = re.compile(r"(?<![A-Za-z0-9_+/=.@-])(?:\(?[0-9]{3}\)\x20?[0-9]{3}[.-][0-9]{4}|[A-Za-z0-9_+/=-]*[0-9][A-Za-z0-9_+/=-]*)"
                       r"(?![A-Za-z0-9_+/=@-]|\.[0-9])")

# Gazetteers and context words.
KEY_PREFIXES = ("sk-", "sk_", "pk_", "ghp_", "gho_", "github_pat_", "xoxb-", "xoxp-", "AKIA", "ASIA", "AIza", "glpat-", "eyJ")
IBAN_COUNTRIES = frozenset("AD AE AL AT AZ BA BE BG BH BR CH CR CY CZ DE DK DO EE ES FI FO FR GB GE GI GL GR GT HR HU IE IL IS IT "
                           "JO KW KZ LB LI LT LU LV MC MD ME MK MR MT MU NL NO PK PL PS PT QA RO RS SA SE SI SK SM TN TR VG XK".split())
CONTEXT = re.compile(r"(?i)(?:token|secret|passw(?:or)?d|passwd|pwd|api[\s_-]?key|access[\s_-]?key|bearer|auth\w*|credential|private[\s_-]?key|"
                     r"ssn|social security|iban|account|konto|cuenta|compte|phone|tel|mobile|fax|call|passport)\b[^\n]{0,12}$")
AGAINST = re.compile(r"(?i)(?:version|page|chapter|section|figure|table|isbn|doi|no\.|nr\.|#|\$|€|£)\s*$")
ASSIGNED = re.compile(r"[:=]\s*[\"']?$")
DATE = re.compile(r"(?:[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{1,2}-[0-9]{1,2}-[0-9]{2,4}|[0-9]{1,4})(?:T[0-9:]+)?")

#: Further candidates.  Fixed patterns: IBANs in printed groups, dotted numbers, what a password word introduces, capitalised words, addresses.
SPACED_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,4})?(?![A-Za-z0-9])")
DOTTED = re.compile(r"(?<![A-Za-z0-9_.@-])[0-9]{3}\.[0-9]{3}\.[0-9]{4}(?![A-Za-z0-9_@-]|\.[0-9])")
PASSWORD = re.compile(r"(?i)(?<![a-z])(?:password|passwort|passwd|pwd|passphrase|passcode|contraseña|mot de passe)[\"']?(?:\x20?[:=]\x20?|\x20is:?\x20)"
                      r"[\"'\x60]?([^\s\"'\x60,;<>]{6,64})")
_CAP = r"[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ'’-]+"
CAPITALS = re.compile(rf"(?<![\w'’-]){_CAP}(?:\x20(?:(?:van|von|de|da|del|la)\x20)?{_CAP}){{0,3}}(?![\w])")
ADDRESS = re.compile(
    rf"(?<![\w.])(?:[0-9]{{1,5}}[A-Za-z]?\x20(?:{_CAP}\x20){{1,3}}(?:Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Drive|Boulevard|Blvd|Court|Square|Terrace|Place|Way)(?!\w)"
    rf"|[A-ZÄÖÜ][a-zäöüß-]+(?:straße|strasse|str\.|weg|platz|allee|gasse)\x20[0-9]{{1,4}}[a-z]?(?!\w)"
    rf"|(?:Calle|Avenida|Plaza|Paseo)\x20(?:de\x20)?(?:la\x20|los\x20)?{_CAP}(?:\x20{_CAP})?,?\x20[0-9]{{1,4}}(?!\w)"
    rf"|[0-9]{{1,4}},?\x20(?:rue|avenue|boulevard|place|chemin)\x20(?:de\x20|du\x20|des\x20)?(?:la\x20)?{_CAP}(?:\x20{_CAP})?)")

# Common first names, titles, what introduces a name or an address, what a capitalised pair is instead, and what a
# password word also introduces.
FIRST_NAMES = frozenset("James John Robert Michael William David Richard Joseph Thomas Charles Christopher Daniel Matthew Anthony Mark Donald Steven Paul "
                        "Andrew Joshua Kenneth Kevin Brian George Edward Ronald Timothy Jason Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica "
                        "Sarah Karen Nancy Lisa Margaret Sandra Ashley Kimberly Emily Donna Michelle Carol Amanda Melissa Deborah Stephanie Laura Alice Anna "
                        "Emma Olivia Sophia Hans Peter Klaus Jürgen Wolfgang Stefan Andreas Ursula Monika Petra Sabine Claudia Jean Pierre Michel Philippe "
                        "Jacques Marie Nathalie Isabelle Catherine Françoise José Juan Carlos Luis Miguel Antonio Manuel Francisco Carmen Josefa Dolores "
                        "Pilar Lucía Sofía Marco Giulia Maria Ahmed Mohammed Fatima Priya Raj Wei Yuki Olga Ivan".split())
TITLE = re.compile(r"(?:^|[^\w])(?:Mr|Mrs|Ms|Miss|Dr|Prof|Herr|Frau|Señora?|Sra?|Mme|Mlle|Monsieur|Madame)\.?\x20$")
NAME_LABEL = re.compile(r"(?i)(?:(?:full|first|last|user)?\x20?name|contact|customer|patient|client|cliente|kunde|nom|nombre|signed|regards)\x20?[:=,]\s*$")
ADDRESS_LABEL = re.compile(r"(?i)(?:address|adresse|dirección|anschrift|lives? (?:at|on)|ship(?:ped)? to|wohnhaft|habite)\b[^\n]{0,12}$")
NO_PERSON = frozenset("Street Avenue Road University College School Institute Hospital Hotel Foundation Prize Award Company Inc Corporation Bank County City "
                      "River Lake Mountain Island Bridge Airport Station Museum Theatre Church Park Day Act Law Award Cup Bible Gospel".split())
NO_PASSWORD = frozenset("required optional reset recovery expired changed invalid incorrect protected protection protector manager policy policies string "
                        "undefined missing hidden unknown nothing something encrypted hashed stored needed forgotten wrong sent empty default secure".split())
YEAR = re.compile(r"(?:19|20)[0-9]{2}\x20")
BEFORE_YEAR = re.compile(r"(?i)(?:in|since|by|of|until|en|im|seit|from)\x20$")

LABELERS = ["shape", "checksum", "mixed", "gazetteer", "context", "assigned", "against"]
NO, YES, NONE = 0, 1, 2


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _lines_with(text: str, what: re.Pattern):
    """(offset, line) of the lines that have a match.  No pattern here spans a line end."""
    at = 0
    while m := what.search(text, at):
        lo = text.rfind("\n", at, m.start()) + 1 or at
        hi = text.find("\n", m.start())
        hi = len(text) if hi < 0 else hi
        yield lo, text[lo:hi]
        at = hi


_DIGIT = re.compile("[0-9]")
#: What a line with a candidate has: a digit, a capital, or a password word.
_HINT = re.compile(r"(?i:passw|pwd|passp|passc|contrase|mot de passe)|[0-9A-ZÀ-ÖØ-Þ]")


#: Words before a span that its labelers see, in characters.
BEFORE = 60


def emails(text: str):
    """The matches of EMAIL, each found from its "@": a run of local characters without one is not searched from every place."""
    at, free = text.find("@"), 0
    while at >= 0:
        m = _DOMAIN.match(text, at)
        if m:
            start = at
            while start > free and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                yield start, m.end()
                free = m.end()
        else:
            free = max(free, at)
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans by kind as listed, then start; failing matches are dropped without a retry."""
    found = {k: [] for k in KINDS}
    found["email"] = list(emails(text))
    for lo, line in _lines_with(text, _DIGIT):
        for m in IP.finditer(line):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                found["ip"].append((lo + m.start(), lo + m.end()))
        for m in CARD.finditer(line):
            d = _digits(m[0])
            if 16 <= len(d) <= 19 and luhn(d):
                found["card"].append((lo + m.start(), lo + m.end()))
        for m in PHONE.finditer(line):
            if 8 <= len(_digits(m[0])) <= 15:
                found["phone"].append((lo + m.start(), lo + m.end()))
    return [(k, a, b) for k in KINDS for a, b in found[k]]


def _iban_ok(s: str) -> bool:
    moved = s[4:] + s[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def votes(kind: str, span: str, before: str, after: str = "") -> list[int]:
    """One vote per labeler; ``before`` and ``after``: the line around the span, BEFORE characters at most."""
    if kind in ("name", "address", "password"):
        return _word_votes(kind, span, before, after)
    digits, letters = sum("0" <= c <= "9" for c in span), sum(c.isalpha() for c in span)
    plain = span.replace(" ", "")
    context = bool(CONTEXT.search(before))
    out = [YES if kind in ("ssn", "iban", "localphone") else YES if kind == "secret" and digits >= 4 and letters >= 4 else
           NO if DATE.fullmatch(span) or kind == "passport" and not context else NONE]
    out.append((YES if _iban_ok(plain) else NO) if kind == "iban" else
               (YES if luhn(_digits(span)) else NONE) if kind == "number" and 13 <= digits <= 19 else
               (YES if not span.startswith(("000", "666", "9")) else NO) if kind == "ssn" else NONE)
    switches = sum(a.isdigit() != b.isdigit() for a, b in zip(span, span[1:]))
    out.append((YES if switches >= 6 else NO) if kind == "secret" else NONE)
    out.append(YES if span.startswith(KEY_PREFIXES) or kind == "iban" and span[:2] in IBAN_COUNTRIES else
               NO if kind == "iban" or kind == "passport" and not context else NONE)
    out.append(YES if context else NO if kind == "passport" else NONE)
    out.append(YES if ASSIGNED.search(before) and kind == "secret" else NO if kind == "number" else NONE)
    out.append(NO if AGAINST.search(before) else NONE)
    return out


def _word_votes(kind: str, span: str, before: str, after: str) -> list[int]:
    """Votes on names, addresses and passwords, which need no digit."""
    words = span.split(" ")
    if kind == "name":
        introduced = bool(TITLE.search(before) or NAME_LABEL.search(before))
        place = any(w in NO_PERSON for w in words) or after.strip().split(" ")[0].strip(".,;:!?") in NO_PERSON
        return [YES if len(words) >= 2 else NONE, NO if place else NONE, NONE, YES if words[0] in FIRST_NAMES else NONE,
                YES if introduced else NONE, YES if NAME_LABEL.search(before) else NONE, NO if place else NONE]
    if kind == "address":
        year = bool(YEAR.match(span) and BEFORE_YEAR.search(before))
        return [NO if year else YES, NO if year else NONE, NONE, YES, YES if ADDRESS_LABEL.search(before) else NONE, NONE, NO if year else NONE]
    common = span.lower().strip(".!?:") in NO_PASSWORD
    kinds = sum(any(f(c) for c in span) for f in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum()))
    assigned = bool(re.search(r"[:=]\x20?[\"'\x60]?$", before))
    return [NO if common else YES if kinds >= 2 or len(span) >= 10 else NONE, NO if common else NONE, YES if kinds >= 3 else NONE,
            NO if common else NONE, NONE if common else YES, YES if assigned else NO, NO if common else NONE]


def _pattern(vote: list[int]) -> int:
    return sum(v * 3 ** i for i, v in enumerate(vote))


def _unpack(patterns: np.ndarray) -> np.ndarray:
    return np.stack([patterns // 3 ** i % 3 for i in range(len(LABELERS))], axis=1)


#: The kinds of further spans, by number.
MORE_KINDS = [*SHAPES, "password", "name", "address"]


def _spans_of(line: str):
    """(kind, start, end) of all candidates of a line, in no order."""
    if _DIGIT.search(line):
        for m in CANDIDATE.finditer(line):
            kind = next((k for k, p in SHAPES.items() if p.fullmatch(m[0])), None)
            if kind:
                yield kind, m.start(), m.end()
        for m in DOTTED.finditer(line):
            yield "localphone", m.start(), m.end()
        for m in SPACED_IBAN.finditer(line):
            yield "iban", m.start(), m.end()
        for m in ADDRESS.finditer(line):
            yield "address", m.start(), m.end()
    for m in PASSWORD.finditer(line):
        yield "password", m.start(1), m.end(1)
    for m in CAPITALS.finditer(line):
        first = m[0].split(" ", 1)[0]
        if first in FIRST_NAMES and " " in m[0]:
            yield "name", m.start(), m.end()
        elif TITLE.search(line, max(0, m.start() - 16), m.start()) or " " in m[0] and NAME_LABEL.search(line, max(0, m.start() - 24), m.start()):
            yield "name", m.start(), m.end()


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int, int, int]]:
    """(kind, start, end, vote pattern, shape) of spans that overlap no base span, by start; of overlapping ones the longer, then the
    first kind of MORE_KINDS."""
    taken = sorted((a, b) for _, a, b in base)
    out = []
    for lo, line in _lines_with(text, _HINT):
        found = sorted(_spans_of(line), key=lambda f: (f[1] - f[2], MORE_KINDS.index(f[0]), f[1]))
        kept: list[tuple[int, int]] = []
        for kind, a, b in found:
            at = bisect.bisect_left(taken, (lo + b, 0))  # base spans that begin before the end; of those only the last few can reach in
            near = bisect.bisect_left(kept, (b, 0))
            if any(e > lo + a for _, e in taken[max(0, at - 4):at]) or near and kept[near - 1][1] > a:
                continue
            kept.insert(near, (a, b))
            span = line[a:b]
            digits = sum("0" <= c <= "9" for c in span)
            shape = MORE_KINDS.index(kind) * 16 + min(3, len(span) // 12) * 4 + min(3, 4 * digits // (len(span) + 1))
            out.append((kind, lo + a, lo + b, _pattern(votes(kind, span, line[max(0, a - BEFORE):a], line[b:b + BEFORE])), shape))
    return sorted(out, key=lambda c: c[1])


def reliabilities(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100):
    """EM over counted vote patterns: share of yes spans, and P(vote | class) per labeler (class, labeler, vote)."""
    v, w = _unpack(patterns), counts.astype(float)
    prior = 0.5
    p = np.zeros((2, v.shape[1], 3))
    p[1, :] = [0.1, 0.5, 0.4]  # to begin with, a vote is right five times in six
    p[0, :] = [0.5, 0.1, 0.4]
    for _ in range(rounds):
        q = posterior(v, prior, p)
        for c, r in ((1, q), (0, 1 - q)):
            for k in range(3):
                p[c, :, k] = ((w * r)[:, None] * (v == k)).sum(axis=0) + 20 * (0.5 if k == c else 0.1 if k == 1 - c else 0.4)
            p[c] /= p[c].sum(axis=1, keepdims=True)
        prior = ((w * q).sum() + 1) / (w.sum() + 2)
    return prior, p


def posterior(v: np.ndarray, prior: float, p: np.ndarray) -> np.ndarray:
    """P(yes); an abstention says nothing."""
    at = np.arange(v.shape[1])
    spoken = v != NONE
    odds = math.log(prior / (1 - prior)) + (np.log(p[1][at, v] / p[0][at, v]) * spoken).sum(axis=1)
    return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def _features(patterns: np.ndarray, shapes: np.ndarray) -> np.ndarray:
    v = _unpack(patterns)
    columns = [np.ones(len(v))]
    columns += [(v[:, i] == k).astype(float) for i in range(v.shape[1]) for k in (NO, YES)]
    columns += [(shapes // 16 == k).astype(float) for k in range(len(MORE_KINDS))]
    columns += [(shapes // 4 % 4 == k).astype(float) for k in range(4)] + [(shapes % 4 == k).astype(float) for k in range(4)]
    return np.stack(columns, axis=1)


def train(patterns: np.ndarray, shapes: np.ndarray, counts: np.ndarray, rounds: int = 50, ridge: float = 1.0) -> np.ndarray:
    """Weights of the span classifier, fitted by Newton steps to the posteriors of all counted spans."""
    prior, p = reliabilities(patterns, counts)
    x, q, w = _features(patterns, shapes), posterior(_unpack(patterns), prior, p), counts.astype(float)
    w = w / max(1.0, w.sum()) * min(w.sum(), 1e6)
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        y = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x.T * (w * y * (1 - y))) @ x + ridge * np.eye(len(beta)), x.T @ (w * (q - y)) - ridge * beta)
        beta += step / max(1.0, float(np.abs(step).max()) / 2)
        if np.abs(step).max() < 1e-8:
            break
    return beta


SPAN = "struct<kind:string,start:int,end:int>"
FOUND = f"doc_id long, base array<{SPAN}>, more array<struct<kind:string,start:int,end:int,votes:int,shape:int>>"


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base spans and candidates with their votes, one row per row of ``docs``."""
    def run(batches):
        span = [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]
        types = [pa.list_(pa.struct(span)), pa.list_(pa.struct([*span, ("votes", pa.int32()), ("shape", pa.int32())]))]
        for lo, n, b in ((lo, n, b) for b in batches for lo, n in slices(b.column(1))):
            texts = b.column(1).slice(lo, n).to_pylist()
            base = [base_spans(t or "") for t in texts]
            more = [candidates(t or "", s) for t, s in zip(texts, base)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(lo, n), pa.array([[dict(zip(("kind", "start", "end"), s)) for s in x] for x in base], types[0]),
                 pa.array([[dict(zip(("kind", "start", "end", "votes", "shape"), s)) for s in x] for x in more], types[1])],
                names=["doc_id", "base", "more"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, FOUND)


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, base (spans of the base kinds) and spans (all, base kinds first as listed, then the
    method's by name; each by start).  Spans are code points, end exclusive.

    A null text has no spans.  Null ids and repeated rows stay as they are.  An empty table gives
    no rows, and without candidates no classifier is needed.  Other columns are not read.
    """
    found = stage(find(docs, id_col, text_col), "spans")
    counted = (found.select(F.explode("more").alias("s")).groupBy("s.votes", "s.shape").agg(F.count(F.lit(1)).alias("n")).toArrow())
    accepted = []
    if counted.num_rows:
        patterns, shapes = counted["votes"].to_numpy(), counted["shape"].to_numpy()
        ok = _features(patterns, shapes) @ train(patterns, shapes, counted["n"].to_numpy()) >= 0
        accepted = (patterns[ok].astype(int) * 4096 + shapes[ok]).tolist()
    d = found.withColumn("_yes", F.array(*(F.lit(k) for k in accepted)).cast("array<int>"))
    return d.select("doc_id", "base", F.concat("base", F.expr(
        "array_sort(transform(filter(more, s -> array_contains(_yes, s.votes * 4096 + s.shape)), "
        "s -> struct(s.kind as kind, s.start as start, s.end as end)))")).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    def joined(c):
        return F.expr(f"array_join(transform({c}, s -> concat_ws(':', s.kind, cast(s.start as string), cast(s.end as string))), ',')")

    return found.select("doc_id", *(F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in KINDS),
                        F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))
