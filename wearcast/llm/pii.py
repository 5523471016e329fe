"""Personal data: base patterns, plus spans decided by weak supervision.

Base spans (e-mail, IP, card, phone) come from fixed patterns and validity rules. Looser
patterns propose candidate spans elsewhere (numbers with a telephone or card shape,
spelled-out or non-ASCII addresses, secrets). Five labelers vote +1, 0 or -1 on each
candidate: shape (regex), checks (digit counts, Luhn, octets, entropy), gazetteer
(top-level domains, calling codes, issuer digits, key names), the words in front of the
span, and the characters around it.

The votes are counted by (kind, vote pattern, length class) over all documents, which is
a table of bounded size. Expectation-maximisation on those counts estimates the share of
true spans of each kind and each labeler's reliability; base spans enter as candidates
known to be true. A logistic span classifier, trained on the cells weighted by their
counts with the posteriors as soft labels, then decides each candidate.

Defined cases: null text counts as empty; offsets are code points, end exclusive; a
candidate that overlaps a base span or an earlier candidate is not proposed; rows with
null or repeated doc_id are handled row by row; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import math
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

KINDS = ("email", "ip", "card", "phone", "secret")
LABELERS = 5
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
EMAIL_RUN = re.compile(r"[A-Za-z0-9._%+@-]*@[A-Za-z0-9._%+@-]*")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# looser shapes of candidates
NUMBER = re.compile(r"(?<![\w.+])[(+]?[0-9][0-9()\x20.-]{5,30}[0-9](?!\w)")
SPELLED = re.compile(r"[\w.%+-]+\s?(?:@|\(at\)|\[at\]|\sat\s)\s?[\w-]+(?:\s?(?:\.|\(dot\)|\[dot\]|\sdot\s)\s?[\w-]+)+", re.I)
# what every match of SPELLED holds, in any case of letters
AT = re.compile(r"@|\(at\)|\[at\]|\sat(?=\s)", re.I)
DOT = re.compile(r"\.|\(dot\)|\[dot\]|\sdot\s", re.I)
SECRET = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}(?![A-Za-z0-9_-])")
# gazetteers
DOMAINS = frozenset("com org net edu gov io info de fr es it uk us eu ch at nl be pl se no fi dk pt cn jp in br ru ca au".split())
CALLING = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "52", "54", "55", "61", "62", "81", "82", "86", "90", "91")
KEY_WORDS = ("key", "token", "secret", "password", "passwd", "pwd", "auth", "bearer", "api")
CUES = {"email": ("mail", "contact", "write", "kontakt", "correo", "courriel"), "ip": ("ip", "host", "server", "addr"),
        "card": ("card", "visa", "master", "credit", "karte", "carte", "tarjeta", "iban"),
        "phone": ("tel", "phone", "call", "fax", "mobil", "cell", "telefon", "teléfono", "téléphone"), "secret": KEY_WORDS}
AGAINST = ("isbn", "version", "page", "figure", "order", "invoice", "id", "no.", "http", "sha", "md5", "commit")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i & 1:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def octets(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in s.split("."))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, leftmost and non-overlapping per kind, failing matches dropped."""
    out = []
    if "@" in text:
        at = 0
        while (at := text.find("@", at)) >= 0:  # only runs around an @ can match
            begin = at
            while begin and (text[begin - 1].isascii() and (text[begin - 1].isalnum() or text[begin - 1] in "._%+-")):
                begin -= 1
            run = EMAIL_RUN.match(text, begin)
            out += [(m.start(), 0, m.end()) for m in EMAIL.finditer(text, begin, run.end())]
            at = max(run.end(), at + 1)
    if "." in text:
        out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if octets(m[0])]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(out)


def entropy(s: str) -> float:
    n = len(s)
    return -sum(k / n * math.log2(k / n) for k in (s.count(c) for c in set(s)))


def _kind_of_number(s: str) -> int:
    if re.fullmatch(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", s):
        return 1
    return 2 if len(_digits(s)) >= 13 else 3


def spelled(text: str) -> list[tuple[int, int]]:
    """Matches of ``SPELLED``, tried only from the word in front of an at mark, so that long words cost their length."""
    out, end = [], 0
    for m in AT.finditer(text) if DOT.search(text) else ():
        stop = m.start() - (m.start() > end and text[m.start() - 1].isspace())
        start = stop
        while start > end and (text[start - 1].isalnum() or text[start - 1] in "_.%+-"):
            start -= 1
        if start < stop and (found := SPELLED.match(text, start)):
            out.append((start, end := found.end()))
    return out


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of looser shapes that overlap no base span, leftmost first."""
    found = []
    found += [(s, 0, e) for s, e in spelled(text)]
    found += [(m.start(), _kind_of_number(m[0]), m.end()) for m in NUMBER.finditer(text) if len(_digits(m[0])) >= 7]
    found += [(m.start(), 4, m.end()) for m in SECRET.finditer(text) if any("0" <= c <= "9" for c in m[0]) and not m[0].isdigit()]
    out, end, taken = [], 0, sorted((s, e) for s, _, e in base)
    for s, k, e in sorted(found):
        if s >= end and not any(a < e and s < b for a, b in taken):
            out.append((s, k, e))
            end = e
    return out


def votes(text: str, start: int, kind: int, end: int) -> tuple[int, ...]:
    """The labelers' votes (-1, 0 or 1) on one span."""
    s, d = text[start:end], _digits(text[start:end])
    before = text[max(0, start - 24):start].lower()
    shape = check = list_ = 0
    if kind == 0:
        shape = 1 if EMAIL.fullmatch(s) else -1 if "@" not in s and "(" not in s and "[" not in s else 0
        check = 1 if s.count("@") == 1 and len(s) <= 80 else -1
        list_ = 1 if re.split(r"[\s.\])]+", s.strip())[-1].lower() in DOMAINS else -1
    elif kind == 1:
        shape, check = 1, 1 if octets(s) else -1
        list_ = 1 if s.startswith(("10.", "192.168.", "172.16.", "127.")) else 0
    elif kind == 2:
        shape = 1 if re.fullmatch(r"[0-9]{4}([ -]?[0-9]{4}){3}|[0-9]{13,19}", s) else -1
        check = 1 if 13 <= len(d) <= 19 and luhn(d) else -1
        list_ = 1 if d[0] in "3456" else -1
    elif kind == 3:
        shape = 1 if re.fullmatch(r"(\+?[0-9]{1,3}[ .-]?)?\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-]?[0-9]{3,4}", s) else -1
        check = 1 if 10 <= len(d) <= 15 else -1
        list_ = 1 if s[0] == "+" and d.startswith(CALLING) else 0
    else:
        hexa = re.fullmatch(r"[0-9a-fA-F]{32,}", s) is not None
        mixed = any(c.islower() for c in s) + any(c.isupper() for c in s) + any(c.isdigit() for c in s)
        shape = 1 if hexa or mixed == 3 else -1
        check = 1 if entropy(s) >= 3.2 else -1
        list_ = 1 if s.startswith(("sk_", "sk-", "pk_", "ghp_", "AKIA", "xox")) else 0
    words = re.findall(r"[^\W\d_]+\.?", before)
    context = 1 if any(w.startswith(CUES[KINDS[kind]]) for w in words) else -1 if any(w in AGAINST for w in words) else 0
    left, right = text[start - 1:start], text[end:end + 1]
    edge = -1 if left.isalnum() or right.isalnum() else 1 if (not left or left.isspace() or left in "\"'(<:=") and (not right or right.isspace() or right in "\"')>.,;") else 0
    return shape, check, list_, context, edge


def pattern_number(v: tuple[int, ...]) -> int:
    out = 0
    for x in v:
        out = out * 3 + x + 1
    return out


def length_class(n: int) -> int:
    return min(n // 8, 7)


def cell_number(kind: int, pattern: int, cls: int) -> int:
    return (kind * 3 ** LABELERS + pattern) * 8 + cls


CELLS = len(KINDS) * 3 ** LABELERS * 8
SPAN = "start int, kind int, stop int, cell int"
FOUND = f"doc_id long, text_key long, base array<struct<{SPAN}>>, loose array<struct<{SPAN}>>"
_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("stop", pa.int32()), ("cell", pa.int32())]))
MARKS = C.byte_table("0-9@")


def _find(batches):
    for b in C.slices(batches):
        texts = C.Texts(C.column(b, "text"))
        mark = np.flatnonzero(texts.per_row(MARKS[texts.data]))  # nothing is proposed without a digit, an @ or a spelled at
        rows = set(mark.tolist())
        marked = [i for i, t in enumerate(C.column(b, "text").to_pylist()) if t and i not in rows and AT.search(t) and DOT.search(t)]
        base, loose = [[] for _ in range(b.num_rows)], [[] for _ in range(b.num_rows)]
        for i in sorted(rows | set(marked)):
            text = C.column(b, "text")[i].as_py()
            spans = base_spans(text)
            for out, found in ((base, spans), (loose, candidates(text, spans))):
                out[i] = [{"start": s, "kind": k, "stop": e, "cell": cell_number(k, pattern_number(votes(text, s, k, e)), length_class(e - s))} for s, k, e in found]
        yield pa.RecordBatch.from_arrays([C.column(b, "doc_id").cast(pa.int64()), C.column(b, "text_key"), pa.array(base, _SPAN), pa.array(loose, _SPAN)],
                                         names=["doc_id", "text_key", "base", "loose"])


def find_spans(docs: DataFrame) -> DataFrame:
    """Base spans and candidates of every row, with the number of their vote cell."""
    return docs.select("doc_id", "text", C.text_key().alias("text_key")).mapInArrow(_find, FOUND)


class SpanModel:
    """Decision of each vote cell: posterior by EM, then a logistic classifier over votes, kind and length."""

    def __init__(self, base: np.ndarray, loose: np.ndarray, rounds: int = 60):
        votes_ = np.array([[(p // 3 ** (LABELERS - 1 - j)) % 3 for j in range(LABELERS)] for p in range(3 ** LABELERS)])
        cell = np.arange(CELLS)
        self.kind, pattern, cls = cell // 8 // 3 ** LABELERS, cell // 8 % 3 ** LABELERS, cell % 8
        vote = votes_[pattern]  # 0, 1, 2 for -1, 0, 1
        used = np.flatnonzero(base + loose)
        self.reliability = np.zeros((len(KINDS), LABELERS, 2, 3))
        share = np.full(len(KINDS), 0.5)
        post = np.clip(0.5 + (vote - 1).sum(1) / (2 * LABELERS), 0.05, 0.95)  # majority vote to begin with
        for _ in range(rounds if len(used) else 0):
            for k in range(len(KINDS)):
                mine = used[self.kind[used] == k]
                if not len(mine):
                    continue
                true = base[mine] + loose[mine] * post[mine]
                false = loose[mine] * (1 - post[mine])
                share[k] = (loose[mine] * post[mine]).sum() / max(loose[mine].sum(), 1e-9) if loose[mine].sum() else 0.5
                for j in range(LABELERS):
                    for c, w in ((0, false), (1, true)):
                        n = np.bincount(vote[mine, j], weights=w, minlength=3) + (1.0, 1.0, 1.0)
                        self.reliability[k, j, c] = n / n.sum()
                log = np.zeros((2, len(mine)))
                for j in range(LABELERS):
                    log += np.log(self.reliability[k, j][:, vote[mine, j]])
                p = np.clip(share[k], 0.02, 0.98)
                z = np.clip(log[1] - log[0] + math.log(p / (1 - p)), -30, 30)
                post[mine] = 1 / (1 + np.exp(-z))
        self.share = share
        # span classifier over one-hot votes within the kind, and the length class
        x = np.zeros((CELLS, LABELERS * 2 + 2))
        x[:, :LABELERS], x[:, LABELERS:2 * LABELERS] = vote == 2, vote == 0
        x[:, -2], x[:, -1] = 1, cls / 7
        self.p = np.zeros(CELLS)
        for k in range(len(KINDS)):
            mine = used[self.kind[used] == k]
            if not len(mine):
                continue
            weight = np.concatenate([base[mine], loose[mine] * post[mine], loose[mine] * (1 - post[mine])])
            feats, y = np.vstack([x[mine]] * 3), np.concatenate([np.ones(2 * len(mine)), np.zeros(len(mine))])
            weight, w = weight / weight.sum(), np.zeros(x.shape[1])
            for _ in range(200):  # Newton steps with a ridge
                p = 1 / (1 + np.exp(-np.clip(feats @ w, -30, 30)))
                g = feats.T @ (weight * (p - y)) + 1e-3 * w
                h = (feats * (weight * p * (1 - p))[:, None]).T @ feats + 1e-3 * np.eye(len(w))
                step = np.linalg.solve(h, g)
                w -= step
                if np.abs(step).max() < 1e-8:
                    break
            self.p[self.kind == k] = 1 / (1 + np.exp(-np.clip(x[self.kind == k] @ w, -30, 30)))


def fit(found: DataFrame) -> SpanModel:
    """Model from the counts of all spans by vote cell (at most ``CELLS`` rows reach the driver)."""
    counts = [np.zeros(CELLS), np.zeros(CELLS)]
    for n, col in enumerate(("base", "loose")):
        for r in found.select(F.explode(col).alias("s")).groupBy("s.cell").count().collect():
            counts[n][r["cell"]] = r["count"]
    return SpanModel(*counts)


def decide(found: DataFrame, model: SpanModel, least: float = 0.5) -> DataFrame:
    """``found`` with ``spans``: base spans and accepted candidates by start, then kind."""
    accepted = [int(c) for c in np.flatnonzero(model.p >= least)]
    keep = F.filter("loose", lambda s: s["cell"].isin(accepted)) if accepted else F.filter("loose", lambda s: F.lit(False))
    return found.withColumn("spans", F.sort_array(F.concat("base", keep))).drop("loose")


def detect(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """doc_id, text_key, base, spans of every row; spans are structs (start, kind number, stop, cell)."""
    found = C.stored(find_spans(docs), "pii-spans")
    return decide(found, fit(found), least)


def listed(col: str):
    """kind:start:end of an array of spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(col, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))))


def redact(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """``docs`` with each merged run of spans in ``text`` replaced by its first kind in brackets; other columns as they are."""
    found = detect(docs, least).where(F.size("spans") > 0).select("doc_id", "text_key", F.transform("spans", lambda s: F.struct(s["start"], s["kind"], s["stop"])).alias("spans"))
    name = f"spans_{uuid.uuid4().hex}"
    joined = C.by_row(docs, C.stored(found, "pii-found").withColumnRenamed("spans", name), "left")
    at = docs.columns.index("text")

    def task(batches):
        for b in batches:
            out = []
            for text, spans in zip(b.column(at).to_pylist(), C.column(b, name).to_pylist()):
                parts, done = [], 0
                for s in spans or ():
                    if s["start"] >= done:
                        parts += [text[done:s["start"]], f"[{KINDS[s['kind']].upper()}]"]
                    done = max(done, s["stop"])
                out.append(text if not parts else "".join(parts) + text[done:])
            cols = list(b.columns)[:-1]
            cols[at] = pa.array(out, b.column(at).type)
            yield pa.RecordBatch.from_arrays(cols, schema=pa.schema(list(b.schema)[:-1]))

    return joined.mapInArrow(task, docs.schema)


def op5_pii(spark, sf_dir):
    out = detect(C.table(spark, sf_dir, "documents"))
    def count(k: int):
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")

    n = [count(k) for k in range(4)]
    return out.select("doc_id", *n, F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))
