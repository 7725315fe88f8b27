"""Personal data: exact base rules plus a character BiLSTM-CRF tagger.

The base rules (email, ip, card, phone) run over every whole text.  The tagger
is trained in numpy on labelled spans: at most ``SAMPLE`` windows per kind and
as many without any, those with the smallest hash, labelled by the base rules,
and copies of them in which separators, plus signs and at signs are written in
other ways, labels kept.  It then reads every stretch of text around a digit, an
at sign or one of its other writings in overlapping windows.  Each window is
decoded by itself; globally, every character takes the tag of the window in
which it lies farthest from an edge, and spans are read off these tags (pieces
of one address are one span, ``_whole``).  A tagged span counts when it touches
no base span and has the shape its kind demands (``plausible``): an address has
one of "@", "(at)", "[at]", the other kinds have a digit every few characters.
The stretches take in whatever can be part of an address around its at sign, of
any length (``_address``), so text outside of them cannot be in a span.

Defined cases: null or empty text has no spans; without any labelled span there
is no tagger and only base spans; rows are judged alone, so repeated rows agree;
other columns are ignored by ``find`` and kept by ``redact``.

Scale: two map-only passes; the training sample is bounded, its windows are cut
in the tasks and picked by a per-kind group limit; the weights are about 30 KB.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bilstm import KINDS, Tagger, char_ids, spans_of, tags_of
from .common import as_bytes, map_arrow, pieces, stage

SAMPLE = 300     # training windows per kind
WIDTH = 64       # characters of a window
STRIDE = 32      # step between overlapping windows
REACH = 32       # characters read on either side of a digit or a possible address

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]")             # what a base span holds
_AT = re.compile(r"@|\(at\)|\[at\]")
_READ = re.compile(rf"[0-9]|{_AT.pattern}")   # what a tagged span holds
_DIGITS = re.compile(r"[0-9]+")
_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The at signs in turn, with the longest local part not used yet before each."""
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and not _NOT_LOCAL.match(text, start - 1):
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            free = found.end()
            at = text.find("@", free)
        else:
            free = at + 1
            at = text.find("@", at + 1)


def ips(text: str) -> Iterator[tuple[int, int]]:
    """Each four parts in turn of a dotted run of digits, all at most 255."""
    for run in _DOTTED.finditer(text):
        if run.group().count(".") < 3:
            continue
        parts = [(run.start() + m.start(), run.start() + m.end()) for m in _DIGITS.finditer(run.group())]
        for k in range(0, len(parts) - 3, 4):
            if all(len(p := text[a:b].lstrip("0")) <= 3 and int(p or "0") <= 255 for a, b in parts[k:k + 4]):
                yield parts[k][0], parts[k + 3][1]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind index) of the base rules, by start, then kind."""
    out: list[tuple[int, int, int]] = []
    if "@" in text:
        out += [(a, b, 0) for a, b in emails(text)]
    if _DIGITS.search(text):
        out += [(a, b, 1) for a, b in ips(text)]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m.group().replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), m.end(), 2))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= sum(map(len, _DIGITS.findall(m.group()))) <= 15:
                    out.append((m.start(), m.end(), 3))
    return sorted(out, key=lambda s: (s[0], s[2]))


# ------------------------------------------------------------------ the tagger
_HOST = r" ?[A-Za-z0-9-]+(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]+)+"
_AFTER = re.compile(_HOST)
_LABEL = re.compile(r"[A-Za-z0-9-]*")
_SHAPES = (
    re.compile(rf"[A-Za-z0-9._%+-]+ ?(?:{_AT.pattern}){_HOST}"),
    re.compile(r"[0-9]{1,3}(?:\s?[.,]\s?[0-9]{1,3}){3}"),
    re.compile(r"[0-9](?:[ . _/-]{0,2}[0-9]){12,18}"),
    re.compile(r"(?:\+|00|\(0|0|\()[0-9](?:[ .()/ -]{0,3}[0-9]){7,14}"),
)


def plausible(piece: str, kind: int) -> bool:
    """Whether a tagged piece has the shape of its kind (cards also pass Luhn)."""
    if not _SHAPES[kind].fullmatch(piece):
        return False
    digits = "".join(_DIGITS.findall(piece))
    if kind == 1:
        return all(int(x) <= 255 for x in _DIGITS.findall(piece))
    if kind == 2:
        return luhn(digits)
    return kind == 0 or 9 <= len(digits) <= 15


def _address(text: str, start: int, end: int) -> tuple[int, int] | None:
    """The longest address whose at sign stands at ``start``:``end``."""
    host = _AFTER.match(text, end)
    at = start - (start > 0 and text[start - 1] == " ")
    first = at
    while first and not _NOT_LOCAL.match(text, first - 1):
        first -= 1
    return (first, host.end()) if host and first < at else None


def windows(text: str) -> Iterator[tuple[int, int]]:
    """Overlapping windows (start, end) that cover all text near a digit or a possible address."""
    near = [m.span() if m.group().isdigit() else _address(text, *m.span()) or m.span() for m in _READ.finditer(text)]
    regions: list[tuple[int, int]] = []
    for first, last in sorted(near):                        # a long address may reach back over digits
        a, b = max(0, first - REACH), min(len(text), last + REACH)
        if regions and a <= regions[-1][1]:
            regions[-1] = (regions[-1][0], max(b, regions[-1][1]))
        else:
            regions.append((a, b))
    for a, b in regions:
        at = a
        while True:
            yield at, min(b, at + WIDTH)
            if at + WIDTH >= b:
                break
            at += STRIDE


def tagged_spans(texts: list[str], tagger: Tagger) -> list[list[tuple[int, int, int]]]:
    """Spans of the tagger in each text, windows reconciled over the whole text."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    jobs: list[tuple[int, int, int]] = [(k, a, b) for k, t in enumerate(texts) for a, b in windows(t)]
    run: list[tuple[int, int, int]] = []            # windows of one region, with their tags
    held: list[np.ndarray] = []

    def close():
        if not run:
            return
        k, begin, end = run[0][0], run[0][1], run[-1][2]
        tags = np.zeros(end - begin, np.int8)
        depth = np.full(end - begin, -1)
        for (_, a, b), t in zip(run, held):
            # distance to the window's edge; the region's own ends are no edge
            left = np.arange(b - a) if a > begin else np.full(b - a, WIDTH)
            right = np.arange(b - a)[::-1] if b < end else np.full(b - a, WIDTH)
            own, at = np.minimum(left, right), slice(a - begin, b - begin)
            better = own > depth[at]
            tags[at][better] = t[:b - a][better]
            depth[at][better] = own[better]
        out[k] += [(begin + a, begin + b, kind) for a, b, kind in spans_of(tags)]
        run.clear()
        held.clear()

    for at in range(0, len(jobs), 2048):
        part = jobs[at:at + 2048]
        decoded = tagger.decode(np.stack([char_ids(texts[k][a:b], WIDTH) for k, a, b in part]))
        for job, tags in zip(part, decoded):
            if run and (job[0] != run[-1][0] or job[1] > run[-1][2]):
                close()
            run.append(job)
            held.append(tags)
    close()
    return out


def _whole(text: str, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """``found`` with the tagged pieces of one address, the at sign's among them, as
    one span: from the start of its local part to the end of its last tagged word."""
    mail = [s for s in found if s[2] == 0]
    starts, ends = [s[0] for s in mail], [s[1] for s in mail]
    gone: set[tuple[int, int, int]] = set()
    joined = []
    for m in _AT.finditer(text) if mail else ():
        whole = _address(text, *m.span())
        if not whole or bisect_right(ends, m.start()) == bisect_left(starts, m.end()):
            continue
        own = mail[bisect_right(ends, whole[0]):bisect_left(starts, whole[1])]
        end = min(whole[1], own[-1][1])
        end = _LABEL.match(text, end).end() if text[end - 1].isalnum() else end
        if plausible(text[whole[0]:end], 0):
            gone.update(own)
            joined.append((whole[0], end, 0))
    return sorted([*(s for s in found if s not in gone), *joined])


def _variants(text: str, spans: list[tuple[int, int, int]], turn: int) -> tuple[str, list[tuple[int, int, int]]]:
    """A labelled window with its spans written in another way."""
    out, moved, last = "", [], 0
    for a, b, kind in spans:
        piece = text[a:b]
        if kind == 0:
            local, _, host = piece.partition("@")
            host = host.replace(".", (".", " (dot) ", "(dot)", " [dot] ", "[dot]")[turn % 5])
            piece = local + (" @ ", "(at)", " [at] ", "@", " (at) ", "[at]")[turn % 6] + host
        elif kind == 1:
            piece = piece.replace(".", (" . ", ",", ". ")[turn % 3])
        elif kind == 2:
            d = piece.replace(" ", "").replace("-", "")
            sep = (".", " ", "_", "/")[turn % 4]
            piece = sep.join(d[k:k + 4] for k in range(0, len(d), 4))
        else:
            piece = ("00", "0", "+")[turn % 3] + piece[1:].replace("-", (".", " ", "/")[turn % 3])
        out += text[last:a]
        moved.append((len(out), len(out) + len(piece), kind))
        out, last = out + piece, b
    out += text[last:]
    return out[:WIDTH], [s for s in moved if s[1] <= WIDTH]


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows around base spans and around other digits, with their labels."""
    for whole in batches:
        for batch in pieces(whole, "text"):
            rows = []
            for raw in as_bytes(batch.column("text")):
                text = raw.decode("utf-8", "replace")
                found = _TRIGGER.search(text)
                if not found:
                    continue
                spans = base_spans(text)
                for a, b, kind in spans:
                    at = max(0, (a + b) // 2 - WIDTH // 2)
                    inside = [s for s in spans if s[0] >= at and s[1] <= at + WIDTH]
                    if (a, b, kind) in inside and all(x[1] <= y[0] for x, y in zip(inside, inside[1:])):
                        rows.append((kind, text[at:at + WIDTH], str([(x - at, y - at, k) for x, y, k in inside])))
                if not spans:
                    at = max(0, found.start() - WIDTH // 2)
                    rows.append((-1, text[at:at + WIDTH], "[]"))
            cols = list(zip(*rows)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.string()),
                                              pa.array(cols[2], pa.string())], ["kind", "piece", "spans"])


def fit(docs: DataFrame, sample: int = SAMPLE) -> Tagger | None:
    """A tagger trained on at most ``sample`` windows per kind (and as many without spans)."""
    import ast
    found = map_arrow(docs.select("text"), _labelled, "kind int, piece string, spans string").distinct()
    order = Window.partitionBy("kind").orderBy(F.xxhash64("piece"), "piece", "spans")
    rows = found.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= sample).collect()
    if not any(r["kind"] >= 0 for r in rows):
        return None
    x, y = [], []
    for r in sorted(rows, key=lambda r: (r["kind"], r["r"])):
        spans = ast.literal_eval(r["spans"])
        both = [(r["piece"], spans)] + ([_variants(r["piece"], spans, r["r"])] if spans else [])
        for piece, own in both:
            x.append(char_ids(piece, WIDTH))
            y.append(tags_of(own, WIDTH))
    return Tagger().train(np.stack(x), np.stack(y)).single()


def all_spans(texts: list[str], tagger: Tagger | None) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text."""
    base = [base_spans(t) for t in texts]
    if tagger is None:
        return [(b, b) for b in base]
    out = []
    for text, own, found in zip(texts, base, tagged_spans(texts, tagger)):
        extra = []
        for a, b, kind in _whole(text, found):
            while a < b and text[a].isspace():
                a += 1
            while b > a and text[b - 1].isspace():
                b -= 1
            if plausible(text[a:b], kind) and all(b <= s[0] or a >= s[1] for s in own):
                extra.append((a, b, kind))
        out.append((own, sorted({*own, *extra}, key=lambda s: (s[0], s[2], s[1]))))
    return out


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def find(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) per document
    of (doc_id, text); the counts and the digest are those of the base spans."""
    tagger = fit(docs, sample)

    def run(batches):
        for whole in batches:
            for batch in pieces(whole, "text"):
                texts = [t.decode("utf-8", "replace") for t in as_bytes(batch.column("text"))]
                both = all_spans(texts, tagger)
                counts = [[sum(s[2] == k for s in base) for base, _ in both] for k in range(4)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts),
                     pa.array([hashlib.sha256(_written(b).encode()).hexdigest() for b, _ in both]),
                     pa.array([_written(a) for _, a in both])],
                    ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    narrow = docs.select("doc_id", "text")
    kind = dict(narrow.dtypes)["doc_id"]
    return map_arrow(narrow, run, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, "
                                  "base_sha256 string, spans string")


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` with each span, or stretch of overlapping spans, as [KIND]."""
    out, last = [], 0
    for a, b, kind in spans:
        if a >= last:
            out += [text[last:a], f"[{KINDS[kind].upper()}]"]
        last = max(last, b)
    return "".join([*out, text[last:]])


def redact(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` (all columns) with personal data replaced in ``text``, and
    ``n_chars`` (if there) counted anew; null text stays null."""
    tagger = fit(docs, sample)

    def run(batches):
        for whole in batches:
            for batch in pieces(whole, "text"):
                texts = [t.decode("utf-8", "replace") for t in as_bytes(batch.column("text"))]
                null = batch.column("text").is_null().to_pylist()
                new = [None if n else redacted(t, spans) for n, t, (_, spans) in zip(null, texts, all_spans(texts, tagger))]
                cols = dict(zip(batch.schema.names, batch.columns))
                cols["text"] = pa.array(new, batch.schema.field("text").type)
                if "n_chars" in cols:
                    kept = cols["n_chars"].to_pylist()
                    cols["n_chars"] = pa.array([k if n or old == t else len(n_) for k, n, old, t, n_ in
                                                zip(kept, null, texts, new, [x or "" for x in new])],
                                               batch.schema.field("n_chars").type)
                yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return map_arrow(docs, run, docs.schema)
