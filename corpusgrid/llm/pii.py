"""Personal data in texts: exact patterns, and a character model that adds spans.

Base spans are emails, IPv4 addresses, card and phone numbers by fixed patterns. A
bidirectional LSTM with a CRF, trained in numpy on labelled spans, reads windows of the
text around every digit and ``@`` (a span of these kinds has one); windows overlap by
half, each character takes its tag from the window where it is most central, and spans
are read off the joined tags of the whole text. A span of the model is added where it
overlaps no base span, its mean posterior is at least ``SURE``, and its digits make sense
for its kind. Base spans always stay.

Labels come from the base patterns (without checksums, which no look can tell) on a hash
sample of about ``sample`` documents, and from rewritten forms of them (other separators,
spaces round ``@``), so that the model learns forms the patterns miss. ``sample`` and ``windows`` bound the fit alone; every text is
searched whole. Texts longer than a batch are searched one by one.

Defined results: a null or empty text has no span. Offsets are code points, ends
exclusive. Repeated rows are searched each. Extra columns pass through.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from corpusgrid.llm import crf
from corpusgrid.llm.memory import small_batches, tidy

KINDS = ("email", "ip", "card", "phone")
SAMPLE, WINDOWS, SURE = 8000, 1200, 0.9
WIDTH, STRIDE, CONTEXT = 64, 32, 16
ANCHOR = re.compile("[0-9@]")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: A match never begins inside a run of digits, so the look-behind only saves retries.
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SPACE_ID, UPPER_ID, OTHER_ID = 1, 2, 3
SYMBOLS = {c: i for i, c in enumerate("abcdefghijklmnopqrstuvwxyz", 4)} | {c: 30 for c in "0123456789"} | {
    c: i for i, c in enumerate("@.+-()_%:/,#\"'=[]", 31)}
N_SYMBOLS = 31 + 17
TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind
CODE = np.full(128, OTHER_ID, np.int64)
for _c in range(128):
    CODE[_c] = SYMBOLS.get(chr(_c), SPACE_ID if chr(_c).isspace() else UPPER_ID if chr(_c).isupper() else OTHER_ID)

Span = tuple[str, int, int]


def digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def luhn(number: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(number))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each ``@`` extends to the left over the local part, so long words are read once."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and LOCAL.match(text[start - 1]):
            start -= 1
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
        done = found.end() if found else at
        at = text.find("@", max(done, at + 1))


def valid(kind: str, text: str) -> bool:
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))
    if kind == "card":
        return 13 <= len(digits(text)) <= 19 and luhn(digits(text))
    if kind == "phone":
        return 9 <= len(digits(text)) <= 15
    return True


def shaped(kind: str, text: str) -> bool:
    """What the look alone can tell; checksums and ranges are left to ``valid``."""
    return kind != "card" or 13 <= len(digits(text)) <= 19


def base_spans(text: str, holds=valid) -> list[Span]:
    """The exact patterns, by kind as listed and then by start."""
    if not ANCHOR.search(text):
        return []
    spans = [("email", a, b) for a, b in emails(text)]
    for kind, pattern in (("ip", IP), ("card", CARD), ("phone", PHONE)):
        spans += [(kind, *m.span()) for m in pattern.finditer(text) if holds(kind, m[0])]
    return spans


def codes_of(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 128, CODE[np.minimum(points, 127)], OTHER_ID)


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches within ``CONTEXT`` of a digit or ``@``, joined where they touch.

    A stretch does not begin inside a run of characters of a local part, but at its start.
    """
    found: list[list[int]] = []
    for m in ANCHOR.finditer(text):
        a, b = max(0, m.start() - CONTEXT), min(len(text), m.end() + CONTEXT)
        met = found[-1][1] if found else 0
        while a > met and LOCAL.match(text, a - 1):
            a -= 1
        if found and a <= found[-1][1]:
            found[-1][1] = b
        else:
            found.append([a, b])
    return [(a, b) for a, b in found]


def tile(a: int, b: int) -> list[int]:
    """Starts of the windows that cover a region."""
    return list(range(a, max(a + 1, b - STRIDE), STRIDE))


def tags_of(n: int, spans: list[Span]) -> np.ndarray:
    """Tags of a text; of overlapping spans the one that is listed first wins."""
    tags = np.zeros(n, np.int64)
    for kind, a, b in reversed(spans):
        tags[a:b] = 2 + 2 * KINDS.index(kind)
        tags[a] -= 1
    return tags


def window_of(codes: np.ndarray, start: int, width: int = WIDTH) -> np.ndarray:
    part = codes[start:start + width]
    return np.pad(part, (0, width - len(part)))


def rewrites(rng: np.random.Generator, kind: str, found: str) -> str:
    """Another way to write the same span."""
    if kind == "email":
        return found.replace("@", " @ ") if rng.random() < 0.5 else found
    plain = digits(found)
    if kind == "phone":
        if rng.random() < 0.5:
            plain = plain[-10:] if len(plain) > 10 else plain
        sep = ["-", ".", " ", ""][int(rng.integers(4))]
        return sep.join([plain[:-7], plain[-7:-4], plain[-4:]])
    if kind == "card":
        sep = [".", "  ", " ", "-"][int(rng.integers(4))]
        return sep.join(plain[i:i + 4] for i in range(0, len(plain), 4))
    return found


def seeds(rng: np.random.Generator, n: int) -> list[tuple[str, list[Span]]]:
    """Labelled texts made from the formats alone, so that a corpus without any still trains."""
    number = lambda k: "".join(map(str, rng.integers(0, 10, k)))
    word = lambda: "".join(chr(97 + int(c)) for c in rng.integers(0, 26, int(rng.integers(2, 9))))
    out = []
    for _ in range(n):
        body = number(15)
        card = next(body + d for d in "0123456789" if luhn(body + d))
        made = {"email": f"{word()}.{number(2)}@{word()}.example.com", "card": card,
                "ip": ".".join(str(rng.integers(0, 256)) for _ in range(4)),
                "phone": f"+{number(1)} ({number(3)}) {number(3)}-{number(4)}"}
        kind = KINDS[int(rng.integers(4))]
        left, right = " ".join(word() for _ in range(3)), " ".join(word() for _ in range(3))
        if rng.random() < 0.2:
            out.append((f"{left} {number(int(rng.integers(1, 9)))} {right}", []))
        else:
            shown = made[kind] if rng.random() < 0.6 else rewrites(rng, kind, made[kind])
            out.append((f"{left} {shown} {right}", [(kind, len(left) + 1, len(left) + 1 + len(shown))]))
    return out


def labelled_windows(docs: DataFrame, sample: int = SAMPLE, windows: int = WINDOWS) -> list[tuple[str, list[Span]]]:
    """At most ``windows`` stretches of text with their base spans, from about ``sample`` documents."""
    share = sample / max(1, docs.count())
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    schema = "key long, part string, kinds array<string>, starts array<int>, ends array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(0).to_pylist():
                spans = base_spans(text or "", shaped)
                for a, b in regions(text or ""):
                    inner = [s for s in spans if a <= s[1] and s[2] <= b]
                    for start in tile(a, b):
                        part = text[start:start + WIDTH]
                        cut = [(k, x - start, y - start) for k, x, y in inner if start <= x and y <= start + WIDTH]
                        key = int.from_bytes(hashlib.blake2b(part.encode(), digest_size=7).digest(), "big")
                        rows.append((key, part, [c[0] for c in cut], [c[1] for c in cut], [c[2] for c in cut]))
            columns = list(zip(*rows)) or [[]] * 5
            kinds = (pa.int64(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int32()))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)],
                                  names=["key", "part", "kinds", "starts", "ends"])

    found = docs.where(place < share).select("text").mapInArrow(run, schema).orderBy("key", "part").limit(windows).collect()
    return [(r["part"], list(zip(r["kinds"], r["starts"], r["ends"]))) for r in found]


def fit(labelled: list[tuple[str, list[Span]]], seed: int = 11) -> dict[str, np.ndarray]:
    """Trains on labelled stretches, their rewritten forms and made ones."""
    rng = np.random.default_rng(seed)
    rows = list(labelled)
    for part, spans in labelled:
        if len(spans) == 1:
            kind, a, b = spans[0]
            shown = rewrites(rng, kind, part[a:b])
            rows.append((part[:a] + shown + part[b:], [(kind, a, a + len(shown))]))
    rows += seeds(rng, max(400, len(rows) // 3))
    codes, tags = [], []
    for part, spans in rows:
        c, t = codes_of(part), tags_of(len(part), spans)
        codes.append(window_of(c, 0))
        tags.append(window_of(t, 0))
    return crf.train(np.stack(codes), np.stack(tags), N_SYMBOLS, TAGS)


def sensible(kind: str, text: str) -> bool:
    if kind == "email":
        left, _, right = text.partition("@")
        return bool(left.strip() and "." in right.strip(". "))
    return (kind != "ip" or len(text.split(".")) == 4 and bool(re.fullmatch("[0-9.]+", text))) and valid(kind, text) and (
        kind != "phone" or bool(re.fullmatch(r"[+(]?[0-9][\x20().0-9-]+[0-9]", text)))


def model_spans(model: dict, texts: list[str], batch: int = 256) -> list[list[Span]]:
    """Spans of the model in each text, from overlapping windows joined over the whole text."""
    places = [(i, a, b, s) for i, t in enumerate(texts) for a, b in regions(t) for s in tile(a, b)]
    codes = {i: codes_of(texts[i]) for i in {p[0] for p in places}}
    joined = {i: (np.zeros(len(c), np.int64), np.zeros(len(c)), np.full(len(c), 1 << 30)) for i, c in codes.items()}
    ramp = np.abs(np.arange(WIDTH) - (WIDTH - 1) / 2)
    for k in range(0, len(places), batch):
        some = places[k:k + batch]
        tags, sure = crf.decode(model, np.stack([window_of(codes[i], s) for i, _, _, s in some]))
        for (i, _, _, s), t, p in zip(some, tags, sure):
            tag, posterior, far = joined[i]
            n = min(WIDTH, len(tag) - s)
            nearer = np.flatnonzero(ramp[:n] < far[s:s + n]) + s
            tag[nearer], posterior[nearer], far[nearer] = t[nearer - s], p[nearer - s], ramp[nearer - s]
    out: list[list[Span]] = [[] for _ in texts]
    for i, (tag, posterior, _) in joined.items():
        at = np.flatnonzero(tag)
        start = None
        for x in [*at.tolist(), len(tag) + 1]:
            if start is not None and (x != last + 1 or tag[x] % 2 or (tag[x] - 1) // 2 != (tag[start] - 1) // 2):
                kind = KINDS[(int(tag[start]) - 1) // 2]
                if tag[start] % 2 and posterior[start:last + 1].mean() >= SURE and sensible(kind, texts[i][start:last + 1]):
                    out[i].append((kind, start, last + 1))
                start = None
            if x <= len(tag) and start is None:
                start = x
            last = x
    return out


def all_spans(base: list[Span], extra: list[Span]) -> list[Span]:
    """Base spans and the extra ones that overlap none of them, by kind and start."""
    taken = sorted((a, b) for _, a, b in base)
    added = [s for s in extra if not any(a < s[2] and s[1] < b for a, b in taken)]
    return sorted(base + added, key=lambda s: (KINDS.index(s[0]), s[1]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


SPAN = StructType().add("kind", StringType()).add("start", IntegerType()).add("end", IntegerType())


def find(docs: DataFrame, sample: int = SAMPLE, windows: int = WINDOWS) -> DataFrame:
    """``docs`` with ``base`` and ``spans`` (arrays of kind, start, end); such columns are replaced."""
    model = fit(labelled_windows(docs, sample, windows))
    rows = docs.drop("base", "spans")
    schema = StructType(list(rows.schema)).add("base", ArrayType(SPAN)).add("spans", ArrayType(SPAN))
    shared, at = docs.sparkSession.sparkContext.broadcast(model), rows.columns.index("text")
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    names = ("kind", "start", "end")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            hit = [i for i, t in enumerate(texts) if ANCHOR.search(t)]
            base, spans = [[] for _ in texts], [[] for _ in texts]
            for i, extra in zip(hit, model_spans(shared.value, [texts[i] for i in hit])):
                base[i] = base_spans(texts[i])
                spans[i] = all_spans(base[i], extra)
            columns = [pa.array([[dict(zip(names, s)) for s in row] for row in found], kind) for found in (base, spans)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=schema.names)
        tidy()

    return small_batches(rows).mapInArrow(run, schema)


def mask(found: DataFrame) -> DataFrame:
    """``found`` with each span of the text replaced by its kind in brackets; overlaps become one."""
    @F.pandas_udf("string")
    def masked(texts, spans):
        out = []
        for text, row in zip(texts, spans):
            parts, done = [], 0
            for start, end, kind in sorted((s["start"], s["end"], s["kind"]) for s in row) if text else []:
                if end > done:
                    parts += [text[done:start], f"[{kind.upper()}]"] if start >= done else []
                    done = end
            out.append(text if not parts else "".join(parts) + text[done:])
        return type(texts)(out)

    hit = F.size("spans") > 0
    return found.withColumn("text", F.when(hit, masked("text", "spans")).otherwise(F.col("text")))
