"""Personal data in whole texts: base rules and a semi-Markov conditional random field (operator 7).

The base spans (email, ip, card, phone) are found by rule and always stay. The field segments the whole text: it weighs whole candidate
spans by their form, checksums and the words before them, and jointly chooses boundaries and types. It adds spans of kinds that the rules have no form
for: ``local_phone`` (no country code), ``iban``, ``national_id`` and ``hidden_email`` (``name (at) host (dot) net``).
Added spans never overlap a base span; spans that it types as one of the base kinds are left to the rules, so the
number of spans of these four kinds is that of the rules.

No labelled personal data exist here, so the field is trained on generated sentences (fixed seed) whose labels are
known: every kind in several forms and contexts, and numbers that are no personal data (orders, dates, versions, sums, codes).

A candidate has at least seven digits, an @ or a spelled-out one, and at most ``WIDEST`` characters. A token that no candidate can cover is no
part of an entity on any path, so the best segmentation of a text is put together from the best ones of the stretches between
such tokens. Only ``regions`` with candidates are therefore handed to the field, each with the tokens around it, whatever their length; this is
the segmentation of the whole text, and a test holds it against that.

Edges: null text is empty text, without spans. Repeated rows are separate rows; an empty table gives no rows. Other
columns are ignored by ``find`` and passed through by ``redact``. A text of digits only is one region; its time grows in proportion to its
length, and what is held of it are back pointers of 45 bytes a token.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepare, table
from .pii_rules import BASE_KINDS, Span, base_spans, luhn, order, sha256, written
from .semi_crf import WIDEST, Field, same_token

ADDED_KINDS = ("local_phone", "iban", "national_id", "hidden_email")
LABELS = ["O", *BASE_KINDS, *ADDED_KINDS]
#: What makes a candidate possible: an @, spelled out or not, or at least so many digits.
AT, DIGIT, DIGITS = re.compile(r"@|[(\[]at[)\]]"), re.compile("[0-9]"), 7
HINTS = {
    "phone": r"phone|tel|call|mobile|fax|cell|dial|llam|appel|anruf",
    "card": r"card|visa|credit|carte|tarjeta|karte",
    "iban": r"iban|account|bank|konto|compte|cuenta",
    "id": r"ssn|social|national|insurance|dni|passport|tax id",
    "mail": r"mail|contact|write",
    "ip": r"\bip\b|host|server|address",
    "number": r"order|ref|invoice|no\.|number|code|date|version|isbn|serial|total|price|key|token",
}
HINT = {k: re.compile(v, re.I) for k, v in HINTS.items()}
AT_MARK = re.compile(r"[(\[]at[)\]]")


def iban_ok(s: str) -> bool:
    s = s.replace(" ", "")
    if not re.fullmatch(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", s):
        return False
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def of_token(text: str, a: int, b: int) -> list[str]:
    kind = "digits" if text[a].isdigit() else "word" if text[a].isalpha() else "white" if text[a].isspace() else "sign"
    return [f"O {kind}", f"O {kind} {min(b - a, 8)}"]


def of_entity(text: str, a: int, b: int) -> list[str] | None:
    """Features of the whole span; None if it can't be an entity."""
    first, last = text[a], text[b - 1]
    if not (first.isalnum() or first in "+(") or not last.isalnum():
        return None
    if a and (text[a - 1].isalnum() or text[a - 1] in "+@") or b < len(text) and (text[b].isalnum() or text[b] == "@"):
        return None
    s = text[a:b]
    digits = re.sub(r"[^0-9]", "", s)
    at, mark = "@" in s, AT_MARK.search(s)
    if len(digits) < DIGITS and not at and not mark or len(digits) > 34 or "\n" in s:
        return None
    shape = re.sub(r"[^\W\d_]+", "w", re.sub(r"[0-9]+", lambda m: str(len(m[0])), s))
    form = re.sub(r"[^\W\d_]+", "w", re.sub(r"[0-9]+", "0", s))
    out = ["E", f"digits {len(digits)}", f"form {form}"]
    out += [f"shape {shape}"] if len(shape) < 24 else []
    out += ["letters"] if re.search(r"[^\W\d_]", s) and not at and not mark else []
    out += ["plus"] if first == "+" else []
    out += ["luhn"] if 12 <= len(digits) <= 19 and luhn(digits) else []
    out += ["iban ok"] if iban_ok(s) else ["iban form"] if re.match(r"[A-Z]{2}[0-9]{2}", s) else []
    out += ["one @"] if re.fullmatch(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", s) else ["odd @"] if at else []
    out += ["spelled"] if re.fullmatch(r"[\w.+-]+ ?[(\[]at[)\]] ?[\w-]+(?:(?: ?[(\[]dot[)\]] ?|\.)[A-Za-z0-9-]+)+", s) else ["odd spelled"] if mark else []
    parts = s.split(".")
    out += ["ip ok"] if len(parts) == 4 and all(p.isdigit() and len(p) < 4 and int(p) < 256 for p in parts) else []
    before = text[max(0, a - 28) : a]
    hinted = [k for k, v in HINT.items() if v.search(before)]
    out += [f"after {k}" for k in hinted] or ["after nothing"]
    out += [f"after {k} form {form}" for k in hinted if len(form) < 24]
    return out


def generated(n: int, seed: int = 7) -> list[tuple[str, list[Span]]]:
    """Sentences with known entities."""
    r = random.Random(seed)
    d = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    h = lambda k: "".join(r.choice("0123456789abcdef") for _ in range(k))
    name = lambda: "".join(r.choice("abcdeilmnorstu") for _ in range(r.randint(3, 8)))

    def card() -> str:
        s = r.choice("45") + d(14)
        s += next(c for c in "0123456789" if luhn(s + c))
        return s if r.random() < 0.5 else r.choice(" -").join(s[i : i + 4] for i in range(0, 16, 4))

    def iban() -> str:
        body = d(18)
        s = next(f"DE{k:02}{body}" for k in range(100) if iban_ok(f"DE{k:02}{body}"))
        return s if r.random() < 0.3 else " ".join(s[i : i + 4] for i in range(0, 22, 4))

    kinds = {
        "email": lambda: f"{name()}{d(2)}@{name()}.{r.choice(['com', 'org', 'net'])}",
        "ip": lambda: ".".join(str(r.randint(1, 255)) for _ in range(4)),
        "card": card,
        "phone": lambda: r.choice([f"+{d(1)} ({d(3)}) {d(3)}-{d(4)}", f"+{d(2)} {d(3)} {d(3)} {d(3)}", f"+{d(11)}", f"+{d(1)}-{d(3)}-{d(3)}-{d(4)}"]),
        "local_phone": lambda: r.choice([f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"{d(3)} {d(3)} {d(4)}", f"{d(3)}.{d(3)}.{d(4)}"]),
        "iban": iban,
        "national_id": lambda: f"{d(3)}-{d(2)}-{d(4)}",
        "hidden_email": lambda: r.choice([f"{name()} (at) {name()} (dot) com", f"{name()}.{name()} [at] {name()} [dot] org", f"{name()} (at) {name()}.net", f"{name()}(at){name()}.com"]),
        "O": lambda: r.choice([d(9), d(12), d(16), d(8), f"{d(4)}-{d(2)}-{d(2)} {d(2)}", f"{d(1)}.{d(2)}.{d(4)}", f"{d(3)},{d(3)},{d(3)}", f"{d(4)} {d(4)}", f"{d(3)}-{d(1)}-{d(2)}-{d(6)}-{d(1)}", f"{d(5)}-{d(4)}", f"{d(2)}.{d(6)} {d(2)}.{d(6)}", f"{d(3)} {d(4)} {d(3)}", f"AB{d(2)} {name()} {d(6)}", f"{d(7)}-{d(3)}", f"{d(4)} {d(4)} {d(4)}", h(32), h(40), h(12).upper(), f"{h(8)}-{h(4)}-{h(4)}-{h(4)}-{h(12)}", f"{name()}_{h(24)}"]),
    }
    before = {
        "phone": ["phone ", "tel: ", "call ", ""], "local_phone": ["phone ", "tel: ", "call me at ", "mobile ", "fax: "], "card": ["card ", "visa ", ""],
        "iban": ["IBAN ", "account ", "bank ", ""], "national_id": ["ssn ", "SSN: ", "social security ", "national id "], "email": ["mail ", ""], "hidden_email": ["mail ", "contact ", "", "write to "],
        "ip": ["host ", "ip ", ""], "O": ["order ", "ref ", "invoice ", "", "", "on ", "version ", "no. ", "total ", "code ", "token = ", "key: "],
    }
    out = []
    for _ in range(n):
        text, spans = "", []
        for _ in range(r.randint(1, 2)):
            text += " ".join(name() for _ in range(r.randint(1, 3))) + r.choice([" ", ", ", ": ", ".\n"])
            kind = r.choice([*kinds, "O", "O"])
            text += r.choice(before[kind])
            s = kinds[kind]()
            if kind == "O" and luhn(re.sub("[^0-9]", "", s)):
                s = d(9)
            if kind != "O":
                spans.append((len(text), len(text) + len(s), kind))
            text += s + r.choice([" ", ".", ", ", ""]) + " "
        out.append((text + name(), spans))
    return out


@lru_cache(1)
def trained(examples: int = 300, epochs: int = 6) -> Field:
    field = Field(LABELS, of_entity, of_token)
    field.train(generated(examples), epochs, rate=0.3, decay=1e-3)
    return field


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches of whole tokens that hold all possible candidates, each with a token after it that none of them covers."""
    reach = [(m.end() - WIDEST, m.start() + WIDEST) for m in AT.finditer(text)]
    at = [m.start() for m in DIGIT.finditer(text)]
    reach += [(q + 1 - WIDEST, p + WIDEST) for p, q in zip(at, at[DIGITS - 1 :], strict=False) if q - p < WIDEST]
    out: list[list[int]] = []
    for a, b in sorted(reach):
        a, b = max(a, 0), min(b, len(text))
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
            continue
        if out:
            out[-1][1] = token_after(text, out[-1][1])
            if a <= out[-1][1]:
                out[-1][1] = max(out[-1][1], b)
                continue
        while a and same_token(text[a - 1], text[a]):
            a -= 1
        if out and a <= out[-1][1]:
            out[-1][1] = b
        else:
            out.append([a, b])
    if out:
        out[-1][1] = token_after(text, out[-1][1])
    return [(a, b) for a, b in out]


def token_after(text: str, at: int) -> int:
    """The end of the token after the one that holds text[at - 1]."""
    for _ in range(2):
        at += at < len(text)
        while at < len(text) and same_token(text[at - 1], text[at]):
            at += 1
    return at


def all_spans(text: str, field: Field) -> tuple[list[Span], list[Span]]:
    """(base spans, base and added spans)."""
    base = base_spans(text)
    added = [(s, e, kind) for a, b in regions(text) for s, e, kind in field.best(text, a, b) if kind in ADDED_KINDS]
    if not added:
        return base, base
    taken = sorted((a, b) for a, b, _ in base)
    starts, ends = [a for a, _ in taken], list(accumulate((b for _, b in taken), max))
    free = [x for x in added if (k := bisect_left(starts, x[1])) == 0 or ends[k - 1] <= x[0]]
    return base, sorted({*base, *free}, key=order)


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_pii long"


def find(docs: DataFrame) -> DataFrame:
    """A row for each document: counts of the base kinds, digest of base spans, all spans and their number."""
    prepare(docs.sparkSession)
    field = trained()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [all_spans(t or "", field) for t in batch.column(1).to_pylist()]
            counts = [pa.array([sum(s[2] == k for s in base) for base, _ in found], pa.int64()) for k in BASE_KINDS]
            yield pa.record_batch([batch.column(0), *counts, pa.array([sha256(written(b)) for b, _ in found], pa.string()), pa.array([written(s) for _, s in found], pa.string()), pa.array([len(s) for _, s in found], pa.int64())], ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_pii"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(of, SCHEMA)


def redacted(text: str, spans: list[Span]) -> str:
    """Each span, overlapping ones together, replaced by its kind in brackets."""
    out, end = [], 0
    for a, b, kind in spans:
        if a >= end:
            out += [text[end:a], f"[{kind.upper()}]"]
        end = max(end, b)
    return "".join([*out, text[end:]])


def redact(docs: DataFrame) -> DataFrame:
    """The same rows and columns, with personal data in text replaced; n_chars follows."""
    prepare(docs.sparkSession)
    field = trained()
    names = docs.columns
    at, size = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            new = [t and redacted(t, all_spans(t, field)[1]) for t in texts]
            batch = batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))
            if size is not None:
                sizes = [n if x == y else len(y) for x, y, n in zip(texts, new, batch.column(size).to_pylist(), strict=True)]
                batch = batch.set_column(size, batch.schema.field(size), pa.array(sizes, batch.schema.field(size).type))
            yield batch

    return docs.mapInArrow(of, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"))
