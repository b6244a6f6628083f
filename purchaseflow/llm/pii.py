"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides.

Base spans have an exact definition and always stay: e-mail addresses, IP addresses, card
numbers that pass the Luhn test, international phone numbers; per kind the leftmost
matches that do not overlap, without another try where one fails its test. Further
candidates are looser: phone numbers without a country code, written-out e-mail addresses,
IPv6 addresses, bank accounts, id numbers, titled names. Decoys look like one kind or
another and are none: card-like numbers that fail the Luhn test, version numbers, ISBNs,
digests. Candidates that overlap a decoy are given up, and decoys are never added.

Each span gets votes (1 personal, -1 not, 0 no opinion) of four labelers: its pattern's
checks, a gazetteer, the words before it, its surroundings. Spans with the same kind, votes
and features form one cell, and only cells are counted, over all documents: at most some
ten thousand whatever the corpus. On the counts expectation-maximisation estimates how
reliable each labeler is for each kind and how likely each cell is personal data. Base spans
are known to be, decoys known not to be; votes of 0 say nothing; rates are drawn towards
labelers that are better than chance, those of a kind towards those of all, and stay better;
and without evidence a candidate is rather not personal data. A logistic model is trained on these likelihoods and decides. Beside kind and votes
it sees what the labelers do not: how long the span is, whether it is parted, whether it
begins a line, and the word behind it (one of FOLLOWERS buckets). Added spans never
overlap base spans or each other.

Defined results: null text is empty text, without spans; without any candidate nothing is
added; positions count code points, ends are exclusive; of added spans that overlap the
one that begins first stays, then the longer one, then the kind that is listed first.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "account", "id", "name")
LIKELY = 0.5
FOLLOWERS = 16
TRUST = (8.0, 2.0)  # prior counts of a labeler's right and wrong votes
KIND_WEIGHT = 10.0  # counts by which a kind's rates are drawn to those of all kinds
CHANCE = 0.55  # every labeler is right more often than this, when it has an opinion
DOUBT = (2.0, 1.0)  # prior counts of candidates that are not personal data, and that are
LABELERS = ("checks", "gazetteer", "context", "surroundings")

# The definition of base spans.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_DOTTED = re.compile(r"[0-9]\.[0-9]")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Looser patterns.
_WRITTEN = re.compile(
    r"[A-Za-z0-9._%+-]{1,64} ?[(\[]at[)\]] ?[A-Za-z0-9-]+"
    r"(?:(?:\.| ?[(\[]dot[)\]] ?)[A-Za-z0-9-]+)+",
    re.IGNORECASE,
)
_LOCAL_PHONE = re.compile(
    r"(?<![\w+.-])(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?![\w-])"
)
_IPV6 = re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![\w:])")
_ACCOUNT = re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
_ID = re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])")
_NAME = re.compile(
    r"(?<!\w)(?:Mr|Mrs|Ms|Dr|Prof|Mme|Mlle|Herr|Frau|Sra|Srta)\.? [A-ZÀ-Þ][a-zà-ÿ]+"
    r"(?: [A-ZÀ-Þ][a-zà-ÿ]+)?"
)

# Patterns of decoys and the kind that each looks like.
_DECOYS = (
    (re.compile(r"(?<![\w.])v?[0-9]+(?:\.[0-9]+){2,}(?![\w.]|\.[0-9])"), "ip"),
    (re.compile(r"(?<![\w-])97[89][- ]?(?:[0-9][- ]?){9}[0-9](?![\w-])"), "phone"),
    (re.compile(r"(?<!\w)(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?!\w)"), "account"),
)

# Gazetteers.
_ENDINGS = frozenset("com org net edu gov io de fr es it uk eu ch at be nl us ca info".split())
_FIRST_NAMES = frozenset(
    "james mary john anna peter paul maria thomas laura michael sarah david julia robert"
    " jean marie pierre sophie hans karl eva juan jose carmen luis ana carlos".split()
)
_CONTEXT = {
    "email": "mail e-mail email contact write courriel correo schreiben",
    "ip": "ip host server address adresse login",
    "card": "card visa mastercard credit carte karte tarjeta pay",
    "phone": "phone tel call fax mobile cell telefon téléphone teléfono",
    "account": "iban account bank konto compte cuenta",
    "id": "ssn social id passport security",
    "name": "dear name contact sincerely from",
}
_AGAINST = frozenset("isbn version order invoice ref token key hash build serial no".split())
_WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)?")
_DIGIT = re.compile(r"[0-9]")


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @ and domain, found from each @ backwards."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            free = found.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int]]]:
    """Base spans in order, and card-like matches that failed their test."""
    found, failed = [], []
    if "@" in text:
        found += [(s, e, "email") for s, e in _emails(text)]
    if _DOTTED.search(text):
        for m in _IP.finditer(text):
            parts = m[0].split(".")
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts):
                found.append((*m.span(), "ip"))
    for m in _CARD.finditer(text):
        if m.end() - m.start() < 13:
            continue
        digits = _digits(m[0])
        if 14 <= len(digits) <= 19 and _luhn(digits):
            found.append((*m.span(), "card"))
        elif 13 <= len(digits) <= 19:
            failed.append(m.span())
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m[0])) <= 15:
                found.append((*m.span(), "phone"))
    return _ordered(found), failed


def _ordered(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def candidates(text: str) -> tuple[list, list, list]:
    """Base spans; looser ones that overlap neither them, decoys nor each other; decoys."""
    base, failed = base_spans(text)
    decoys = [(s, e, "card") for s, e in failed]
    if _DIGIT.search(text):
        taken = _Taken((s, e) for s, e, _ in base)
        for pattern, kind in _DECOYS:
            spans = (m.span() for m in pattern.finditer(text))
            decoys += [(s, e, kind) for s, e in spans if not taken.overlaps(s, e)]
    loose = []
    if "(" in text or "[" in text:
        loose += [(*m.span(), "email") for m in _WRITTEN.finditer(text)]
    if re.search(r"[0-9][ .)-][0-9 ]", text):
        loose += [(*m.span(), "phone") for m in _LOCAL_PHONE.finditer(text)]
        loose += [(*m.span(), "id") for m in _ID.finditer(text)]
    if ":" in text:
        loose += [(*m.span(), "ip") for m in _IPV6.finditer(text)]
    if re.search(r"[A-Z][0-9]", text):
        loose += [(*m.span(), "account") for m in _ACCOUNT.finditer(text)]
    loose += [(*m.span(), "name") for m in _NAME.finditer(text)]
    kept, taken = [], _Taken((s, e) for s, e, _ in (*base, *decoys))
    for s, e, kind in sorted(loose, key=lambda x: (x[0], -x[1], KINDS.index(x[2]))):
        if (not kept or s >= kept[-1][1]) and not taken.overlaps(s, e):
            kept.append((s, e, kind))
    return base, kept, decoys


class _Taken:
    """Places of a text that are taken, to be asked for in logarithmic time."""

    def __init__(self, spans):
        self._starts, self._ends = [], []
        for start, end in sorted(spans):
            if self._ends and start <= self._ends[-1]:
                self._ends[-1] = max(self._ends[-1], end)
            else:
                self._starts.append(start)
                self._ends.append(end)

    def overlaps(self, start: int, end: int) -> bool:
        after = bisect_right(self._ends, start)
        return after < len(self._starts) and self._starts[after] < end


def _votes(text: str, start: int, end: int, kind: str) -> tuple[int, int, int, int]:
    span = text[start:end]
    digits = _digits(span)
    if kind == "card":
        checks = 1 if _luhn(digits) and len(digits) >= 14 else -1
    elif kind == "account":
        plain = span.replace(" ", "")
        number = "".join(str(int(c, 36)) for c in plain[4:] + plain[:4])
        checks = 1 if int(number) % 97 == 1 else -1
    elif kind == "id":
        checks = -1 if span[:3] in ("000", "666") or span[0] == "9" or span[-4:] == "0000" else 1
    elif kind == "phone":
        checks = 1 if span[0] == "+" else 0
    elif kind == "ip":
        parts = span.split(".")
        checks = 1 if ":" in span or len(parts) == 4 and all(len(p) < 4 for p in parts) else -1
    elif kind == "email":
        checks = 1 if "@" in span or re.search(r"[A-Za-z]{2}$", span) else -1
    else:
        checks = 0
    gazetteer = 0
    if kind == "email":
        ending = re.split(r"[.)\]\s]+", span.lower())[-1]
        gazetteer = 1 if ending in _ENDINGS else -1
    elif kind == "name":
        gazetteer = 1 if any(w.lower() in _FIRST_NAMES for w in span.split()) else 0
    elif kind == "card":
        gazetteer = 1 if digits[:1] in ("3", "4", "5", "6") else 0
    before = [w.lower() for w in _WORD.findall(text[max(0, start - 40) : start])][-4:]
    own = _CONTEXT[kind].split()
    context = 1 if any(w in own for w in before) else -1 if _AGAINST.intersection(before) else 0
    left, right = text[start - 1 : start], text[end : end + 1]
    joined = left.isalnum() or right.isalnum() or left in ("_", "=", "/", "$") or right == "_"
    return checks, gazetteer, context, -1 if joined and left + right else 0


def cell(text: str, start: int, end: int, kind: str, known: str = "") -> str:
    """What the models see of a span: kind, votes, what voters do not see, and what is known.

    ``known`` is "=1" for base spans, "=0" for decoys.
    """
    span = text[start:end]
    digits = min(len(_digits(span)) // 3, 6)
    separated = int(any(c in " .-()" for c in span))
    line = int(start == 0 or text[start - 1] == "\n")
    behind = _WORD.search(text, end, end + 24)
    word = zlib.crc32(behind[0].lower().encode()) % FOLLOWERS if behind else "n"
    seen = [kind, *map(str, _votes(text, start, end, kind)), f"d{digits}", f"s{separated}"]
    return ",".join([*seen, f"l{line}", f"b{word}", *[known] * bool(known)])


def _cells(text: str) -> list[str]:
    base, loose, decoys = candidates(text)
    return [
        *[cell(text, *s, "=1") for s in base],
        *[cell(text, *s) for s in loose],
        *[cell(text, *s, "=0") for s in decoys],
    ]


def reliabilities(cells: Mapping[str, int], rounds: int = 100) -> tuple[dict[str, float], np.ndarray]:
    """EM over cell counts: how likely each cell is personal data, and the labelers' rates.

    The rates are P(vote | personal or not, an opinion) by labeler, class and vote
    (-1, 0, 1), over all kinds.
    """
    names = sorted(cells)
    fields = [name.split(",") for name in names]
    votes = np.array([[int(v) for v in f[1:5]] for f in fields])
    count = np.array([cells[name] for name in names], dtype=float)
    kinds = sorted({f[0] for f in fields})
    kind = np.array([kinds.index(f[0]) for f in fields])
    known = np.array([{"=1": 1.0, "=0": 0.0}.get(f[-1], np.nan) for f in fields])
    open_ = np.isnan(known)
    likely = np.where(open_, 1 / (1 + np.exp(-votes.sum(axis=1).astype(float))), known)
    prior_votes = np.zeros((2, 3))  # by class and vote
    prior_votes[1, 2] = prior_votes[0, 0] = TRUST[0]
    prior_votes[1, 0] = prior_votes[0, 2] = TRUST[1]
    opinion = votes != 0
    for _ in range(rounds):
        before = likely
        mass = np.stack([count * (1 - likely), count * likely])
        seen = np.zeros((len(kinds), len(LABELERS), 2, 3))
        for k in range(len(LABELERS)):
            at = opinion[:, k]
            for y in (0, 1):
                np.add.at(seen[:, k, y], (kind[at], votes[at, k] + 1), mass[y][at])
        rates = seen.sum(axis=0) + prior_votes
        rates /= rates.sum(axis=-1, keepdims=True)
        own = seen + KIND_WEIGHT * rates
        own /= own.sum(axis=-1, keepdims=True)
        for y, right in ((0, 0), (1, 2)):
            own[:, :, y, right] = np.maximum(own[:, :, y, right], CHANCE)
            own[:, :, y, 2 - right] = np.minimum(own[:, :, y, 2 - right], 1 - CHANCE)
        # how many of a kind's open candidates are personal data
        share = np.tile(DOUBT, (len(kinds), 1))
        for y in (0, 1):
            np.add.at(share[:, y], kind[open_], mass[y][open_])
        log = np.log(share / share.sum(axis=1, keepdims=True))[kind].T
        for k in range(len(LABELERS)):
            term = np.log(np.maximum(own[kind, k][np.arange(len(names)), :, votes[:, k] + 1], 1e-9))
            log = log + np.where(opinion[:, k], term.T, 0.0)
        likely = np.where(open_, 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50))), known)
        if np.abs(likely - before).max(initial=0) < 1e-9:
            break
    return dict(zip(names, likely.tolist(), strict=True)), rates


def train(cells: Mapping[str, int]) -> dict[str, float]:
    """The classifier's probability for each cell, trained on the EM likelihoods."""
    if not cells:
        return {}
    likely, _ = reliabilities(cells)
    names = sorted(cells)
    fields = [name.split(",") for name in names]
    fields = [f[:-1] if f[-1][0] == "=" else f for f in fields]
    # votes weigh by kind, the other features for all kinds alike
    marked = [[f[0], *[(f[0], i, v) for i, v in enumerate(f[1:5])], *f[5:]] for f in fields]
    columns = {c: k for k, c in enumerate(sorted({x for m in marked for x in m}, key=str))}
    x = np.zeros((len(names), len(columns) + 1))
    x[:, -1] = 1
    for row, m in enumerate(marked):
        x[row, [columns[c] for c in m]] = 1
    y = np.array([likely[name] for name in names])
    weight = np.sqrt(np.array([cells[name] for name in names], dtype=float))
    weight /= weight.sum()
    w, ridge = np.zeros(x.shape[1]), 1e-4
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) + ridge * w
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x
        w -= np.linalg.solve(curve + ridge * np.eye(w.size), slope)
    p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
    return dict(zip(names, p.tolist(), strict=True))


def fit(df: DataFrame, text: str = "text") -> dict[str, float]:
    """Counts the cells of all candidates of all documents and trains on the counts."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Counter()
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                for whole in batch.column(0).slice(start, 256).to_pylist():
                    if whole:
                        found.update(_cells(whole))
        yield pa.RecordBatch.from_pydict(
            {"cell": pa.array(list(found), pa.string()), "n": pa.array(found.values(), pa.int64())}
        )

    cells = df.select(df[text].alias("text")).mapInArrow(counted, "cell string, n long")
    rows = cells.groupBy("cell").agg(F.sum("n").alias("n")).collect()
    return train({row["cell"]: row["n"] for row in rows})


def spans(text: str, model: Mapping[str, float]) -> tuple[list, list]:
    """Base spans, and all spans: base ones and candidates that the classifier takes."""
    base, loose, _ = candidates(text)
    added = [s for s in loose if model.get(cell(text, *s), 0.0) >= LIKELY]
    return base, _ordered(base + added)


def _shown(found: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in found)


def detect(
    df: DataFrame, model: Mapping[str, float], doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: doc_id, n_<kind> of base spans, base_sha256, spans."""
    slim = df.select(df[doc_id].alias("doc_id"), df[text].alias("text"))
    counts = [f"n_{kind}" for kind in BASE]

    def detected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for start in range(0, batch.num_rows, 256):
                for whole in batch.column(1).slice(start, 256).to_pylist():
                    base, every = spans(whole or "", model)
                    kinds = Counter(kind for _, _, kind in base)
                    digest = hashlib.sha256(_shown(base).encode()).hexdigest()
                    rows.append((*(kinds[k] for k in BASE), digest, _shown(every)))
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            types = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))],
                names=["doc_id", *counts, "base_sha256", "spans"],
            )

    schema = T.StructType(
        [
            slim.schema["doc_id"],
            *[T.StructField(name, T.LongType()) for name in counts],
            T.StructField("base_sha256", T.StringType()),
            T.StructField("spans", T.StringType()),
        ]
    )
    return slim.mapInArrow(detected, schema)


def masked(text: str | None, model: Mapping[str, float]) -> str | None:
    """``text`` with each span replaced by its kind, as in <EMAIL>; overlaps become one."""
    if not text:
        return text
    found, parts, done = spans(text, model)[1], [], 0
    for start, end, kind in found:
        if start >= done:
            parts += [text[done:start], f"<{kind.upper()}>"]
        done = max(done, end)
    return "".join([*parts, text[done:]]) if found else text


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: personal data gives way to its kind; ``n_chars`` is counted anew."""
    model = fit(docs)

    def hide(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            slices = (texts.slice(start, 256) for start in range(0, len(texts), 256))
            parts = [
                pa.array([masked(text, model) for text in part.to_pylist()], pa.string())
                for part in slices
            ]
            yield pa.concat_arrays(parts) if parts else texts

    mask = F.arrow_udf(hide, "string")
    anew = {"text": F.col("__masked")}
    if "n_chars" in docs.columns:
        anew["n_chars"] = F.length("__masked").cast(docs.schema["n_chars"].dataType)
    hidden = docs.withColumn("__masked", mask("text"))
    return hidden.select(*[anew.get(c, F.col(c)).alias(c) for c in docs.columns])
