"""Secret scan: fixed patterns, and a linear-chain conditional random field.

The patterns give the base spans. The field tags every token of a text as
beginning of, inside or outside a secret, from its shape, the shapes of its
neighbours and features of the whole text, decoded by Viterbi; spans that it
finds apart from the base ones are added.

A token's features make up its type, and there are few types, so scores are
sums of per-type tables. Viterbi is exact but runs only where it can matter: a
token whose best score for a secret lies so far below that for "outside" that no
transition can make up for it is outside in every best sequence; the stretches
between such tokens are decoded one by one.

The field is fitted on stretches of at most ``MAX_TRAIN`` rows (chosen by a hash
of id and text). Base spans of those rows are secrets (up to ``MAX_SECRETS`` of a
text give a stretch each); so that the field does not merely learn the patterns,
each stretch also comes in disguise: made-up secrets of other forms, quoted or
spaced, behind other words or none, take the place of a token, and so do
made-up names, paths, dates and numbers that are no secrets (``disguised``).

Defined cases: null counts as empty; an empty text has no spans; without a
training row that has a secret only base spans are found; repeated rows are
scanned row by row; an empty table gives an empty result; other columns are
ignored. Offsets are code points, ends exclusive; whole texts are scanned.
"""

from __future__ import annotations

import random
import re
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import chunks, hashed_rows, id_text, id_type

MAX_TRAIN = 3000
MAX_WINDOWS = 4000       # training stretches, half of them without a secret
MAX_SECRETS = 64
WINDOW = 40              # tokens of a stretch
CACHE_TOKENS = 500_000

# The base patterns and their order.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are taken whole, so shorter ones need not be met
KINDS = ("assign", "access", "hex", "crf")
KEYWORDS = ("password", "passwd", "secret", "token", "api", "key", "credential", "auth", "bearer", "private",
            "pwd", "pass")
_CUES = ("passw", "secret", "token", "api")

Span = tuple[str, int, int]


def base_spans(text: str) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, start of the secret itself) of the fixed patterns, in order."""
    out = []
    low = text.lower()
    if any(c in low for c in _CUES):
        out += [("assign", m.start(), m.end(), m.start(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), m.start()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [("hex", m.start(), m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


# --------------------------------------------------------------- features
TOKEN = re.compile(r"[\w+/.\-]+|[^\w\s]")
_SHAPES = ("lower", "title", "upper", "digits", "hex", "low+digit", "up+digit", "mixed", "symbol", "foreign", "mark")
_MARKS = "=:\"'(),;@#$&*|!?{}[]<>"
_LENGTHS = (2, 4, 8, 16, 24, 40)
_TEXT_FEATURES = 6
N_FEATURES = len(_SHAPES) * (len(_LENGTHS) + 1) + len(_MARKS) + 1 + 3 + 4 + 1


def _bucket(value: float, edges) -> int:
    return sum(value >= e for e in edges)


def token_features(token: str) -> tuple[int, ...]:
    """Numbers of the features that hold for a token."""
    n, base = len(token), len(_SHAPES) * (len(_LENGTHS) + 1)
    if n == 1 and not token.isalnum():
        mark = _MARKS.find(token)
        return (_SHAPES.index("mark") * (len(_LENGTHS) + 1), base + (mark if mark >= 0 else len(_MARKS)))
    core = token.rstrip(".")
    digits = any(c.isdigit() for c in core)
    if not core.isascii():
        shape = "foreign"
    elif not core.isalnum():
        shape = "symbol"
    elif core.isdigit():
        shape = "digits"
    elif digits and all(c in "0123456789abcdef" for c in core):
        shape = "hex"
    elif digits:
        shape = "low+digit" if core.islower() else "up+digit" if core.isupper() else "mixed"
    elif core.islower():
        shape = "lower"
    elif core.isupper():
        shape = "upper"
    else:
        shape = "title" if core[1:].islower() else "mixed"
    out = [_SHAPES.index(shape) * (len(_LENGTHS) + 1) + _bucket(n, _LENGTHS)]
    base += len(_MARKS) + 1
    if n >= 8 and shape not in ("lower", "title", "foreign"):
        out.append(base + _bucket(len(set(core)) / n, (0.4, 0.65)))
    base += 3
    if digits:
        changes = sum(a.isdigit() != b.isdigit() for a, b in zip(core, core[1:]))
        out.append(base + _bucket(changes, (1, 3, 6)))
    base += 4
    if any(k in token.lower() for k in KEYWORDS):
        out.append(base)
    return tuple(out)


class Types:
    """Numbers tokens by their feature set; the table of a type is a row of
    ``matrix``. Type 0 is the edge of a text."""

    def __init__(self):
        self.number: dict[tuple, int] = {(): 0}
        self.rows = [np.zeros(N_FEATURES)]
        self.cache: dict[str, int] = {}

    def _type(self, token: str) -> int:
        key = token_features(token)
        if key not in self.number:
            self.number[key] = len(self.rows)
            row = np.zeros(N_FEATURES)
            row[list(key)] = 1.0
            self.rows.append(row)
        return self.number[key]

    def of(self, tokens: list[str]) -> np.ndarray:
        cache = self.cache
        try:
            return np.fromiter(map(cache.__getitem__, tokens), np.int32, len(tokens))
        except KeyError:
            if len(cache) > CACHE_TOKENS:
                cache.clear()
            for t in set(tokens).difference(cache):
                cache[t] = self._type(t)
            return np.fromiter(map(cache.__getitem__, tokens), np.int32, len(tokens))

    def matrix(self) -> np.ndarray:
        return np.array(self.rows)


def text_features(text: str) -> np.ndarray:
    """Features of the whole text: how common assignment marks and braces are."""
    n = max(1, len(text))
    rate = 1000.0 * (text.count("=") + text.count(":")) / n
    braces = 1000.0 * (text.count("{") + text.count(";")) / n
    out = np.zeros(_TEXT_FEATURES)
    out[_bucket(rate, (0.5, 5.0))] = 1.0
    out[3 + _bucket(braces, (0.5, 5.0))] = 1.0
    return out


# ------------------------------------------------------------------ field
O, B, I = 0, 1, 2  # noqa: E741
ROLES = (0, -1, -2, 1)  # the token itself, the two before it, the one after it


def _neighbour(types: np.ndarray, shift: int) -> np.ndarray:
    """Types at a distance along the last axis, 0 beyond the ends."""
    out = np.zeros_like(types)
    if shift == 0:
        out[:] = types
    elif shift < 0:
        out[..., -shift:] = types[..., :shift]
    else:
        out[..., :-shift] = types[..., shift:]
    return out


class Field:
    """Weights: for each role a table features x tags, text features x tags,
    and transitions (tags before and after a text count as outside)."""

    def __init__(self):
        self.roles = [np.zeros((N_FEATURES, 3)) for _ in ROLES]
        self.text = np.zeros((_TEXT_FEATURES, 3))
        self.move = np.zeros((3, 3))
        self.trained = False

    def _params(self) -> list[np.ndarray]:
        return [*self.roles, self.text, self.move]

    def fit(self, types: np.ndarray, text: np.ndarray, tags: np.ndarray, matrix: np.ndarray, epochs: int = 12,
            batch: int = 200, rate: float = 0.3, l2: float = 1e-5, seed: int = 3) -> Field:
        """Maximise the likelihood of ``tags`` (windows x tokens) by Adagrad."""
        rng = np.random.default_rng(seed)
        params = self._params()
        sums = [np.full_like(p, 1e-6) for p in params]
        for _ in range(epochs):
            for at in np.array_split(rng.permutation(len(types)), max(1, len(types) // batch)):
                grads = self._gradient(types[at], text[at], tags[at], matrix)
                for p, g, s in zip(params, grads, sums):
                    g = g / len(at) - l2 * p
                    s += g * g
                    p += rate * g / np.sqrt(s)
        self.trained = True
        return self

    def _gradient(self, types, text, tags, matrix):
        n, length = types.shape
        near = [_neighbour(types, r) for r in ROLES]
        unary = sum((matrix @ w)[t] for w, t in zip(self.roles, near)) + (text @ self.text)[:, None, :]

        def log_sum(x, axis):
            top = x.max(axis=axis, keepdims=True)
            return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)

        fwd = np.empty((n, length, 3))
        bwd = np.empty((n, length, 3))
        fwd[:, 0] = unary[:, 0] + self.move[O]
        for i in range(1, length):
            fwd[:, i] = log_sum(fwd[:, i - 1, :, None] + self.move[None], 1) + unary[:, i]
        bwd[:, -1] = self.move[:, O]
        for i in range(length - 2, -1, -1):
            bwd[:, i] = log_sum(self.move[None] + (unary[:, i + 1] + bwd[:, i + 1])[:, None, :], 2)
        total = log_sum(fwd[:, -1] + bwd[:, -1], 1)
        p = np.exp(fwd + bwd - total[:, None, None])
        pairs = np.exp(fwd[:, :-1, :, None] + self.move[None, None] + (unary + bwd)[:, 1:, None, :]
                       - total[:, None, None, None]).sum(axis=(0, 1))
        gold = np.eye(3)[tags]
        diff = gold - p
        grads = []
        for t in near:
            per_type = np.zeros((len(matrix), 3))
            np.add.at(per_type, t.ravel(), diff.reshape(-1, 3))
            grads.append(matrix.T @ per_type)
        grads.append(text.T @ diff.sum(axis=1))
        move = np.einsum("nta,ntb->ab", gold[:, :-1], gold[:, 1:]) - pairs
        move[O] += gold[:, 0].sum(axis=0) - p[:, 0].sum(axis=0)
        move[:, O] += gold[:, -1].sum(axis=0) - p[:, -1].sum(axis=0)
        grads.append(move)
        return grads

    def tables(self, matrix: np.ndarray) -> list[np.ndarray]:
        return [matrix @ w for w in self.roles]

    def slack(self) -> float:
        """The most that transitions can favour a secret tag over "outside" at one place."""
        m = self.move
        return max(m[a, x] + m[x, b] - m[a, O] - m[O, b] for a in range(3) for b in range(3) for x in (B, I))

    def viterbi(self, unary: np.ndarray) -> np.ndarray:
        """Best tags of a stretch between two tokens that are outside."""
        score = unary[0] + self.move[O]
        back = np.zeros((len(unary), 3), np.int64)
        for i in range(1, len(unary)):
            step = score[:, None] + self.move
            back[i] = step.argmax(axis=0)
            score = step.max(axis=0) + unary[i]
        tag = int((score + self.move[:, O]).argmax())
        out = np.empty(len(unary), np.int64)
        for i in range(len(unary) - 1, -1, -1):
            out[i] = tag
            tag = int(back[i, tag])
        return out


class Scanner:
    """Applies a field to texts; one per worker, so that types are kept."""

    def __init__(self, field: Field):
        self.field, self.types = field, Types()
        self.known = 0
        self.barrier = -field.slack()

    def _refresh(self) -> None:
        if self.known != len(self.types.rows):
            self.known = len(self.types.rows)
            self.tables = self.field.tables(self.types.matrix())
            self.gain = [t[:, 1:].max(axis=1) - t[:, O] for t in self.tables]

    def tags(self, types: np.ndarray, text: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(first token, tags) of the stretches that are not plainly outside."""
        self._refresh()
        of_text = text @ self.field.text
        near = [_neighbour(types, r) for r in ROLES]
        bound = sum(g[t] for g, t in zip(self.gain, near)) + (of_text[1:].max() - of_text[O])
        open_at = np.flatnonzero(bound >= self.barrier)
        if not len(open_at):
            return
        for run in np.split(open_at, np.flatnonzero(np.diff(open_at) > 1) + 1):
            unary = sum(table[t[run]] for table, t in zip(self.tables, near)) + of_text
            yield int(run[0]), self.field.viterbi(unary)

    def spans(self, text: str) -> list[Span]:
        base = base_spans(text)
        found: list[Span] = [s[:3] for s in base]
        if not self.field.trained:
            return found
        tokens = TOKEN.findall(text)
        if not tokens:
            return found
        marked = [(at, tags) for at, tags in self.tags(self.types.of(tokens), text_features(text)) if tags.any()]
        if not marked:
            return found
        where = [m.span() for m in TOKEN.finditer(text)]
        for at, tags in marked:
            i = 0
            while i < len(tags):
                if tags[i] == O:
                    i += 1
                    continue
                j = i + 1
                while j < len(tags) and tags[j] == I:
                    j += 1
                start, end = where[at + i][0], where[at + j - 1][1]
                if not any(s < end and start < e for _, s, e, _ in base):
                    found.append(("crf", start, end))
                i = j
        return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


# -------------------------------------------------------------- operators
_LETTERS, _HEX = string.ascii_letters + string.digits, "0123456789abcdef"
_LEAD_INS = ((), (), ("=",), ("key", "="), ("credential", "="), ("DB_PASS", ":"), ("pwd", "="), ("Authorization", ":", "Bearer"),
             ("bearer",), ("auth", ":"), ("value", "="), ("PRIVATE_KEY", "="), ("is",), (":",))


def made_secret(rng: random.Random) -> list[str]:
    """Tokens of a secret: random characters, some behind a short prefix or in groups."""
    def some(alphabet: str, low: int, high: int) -> str:
        return "".join(rng.choices(alphabet, k=rng.randint(low, high)))

    kind = rng.randrange(6)
    if kind == 0:
        return [some(_LETTERS, 16, 64)]
    if kind == 1:  # a prefix that names the issuer
        return [some(string.ascii_lowercase, 2, 4) + rng.choice("_-") + rng.choice(["", "live_", "test-", "pat_"])
                + some(_LETTERS, 16, 48)]
    if kind == 2:  # groups
        return ["-".join(some(_LETTERS, 8, 24) for _ in range(rng.randint(2, 4)))]
    if kind == 3:  # base 64
        return [some(_LETTERS + "+/", 24, 76), *["="] * rng.randint(0, 2)]
    if kind == 4:
        return [some(string.ascii_uppercase + string.digits, 16, 40)]
    return [some(_HEX, 16, 23) if rng.random() < .5 else some(_LETTERS + "_.-", 12, 32)]


def made_name(rng: random.Random) -> list[str]:
    """Tokens that look out of the ordinary and are no secret."""
    def word() -> str:
        return "".join(rng.choices(string.ascii_lowercase, k=rng.randint(2, 10)))

    kind, n = rng.randrange(10), rng.randint(2, 6)
    if kind == 0:
        return ["/".join(word() for _ in range(n)) + rng.choice(["", "/", ".html", ".py"])]
    if kind == 1:
        return [rng.choice("_-.").join(word() for _ in range(n))]
    if kind == 2:
        return ["".join(word().title() for _ in range(n))]
    if kind == 3:
        return [rng.choice(["%04d-%02d-%02d", "%04d/%02d/%02d", "v%d.%d.%d"])
                % (rng.randint(1, 2030), rng.randint(1, 12), rng.randint(1, 28))]
    if kind == 4:
        return [str(rng.randrange(10 ** rng.randint(1, 16)))]
    if kind == 5:
        return [word(), rng.choice(":="), rng.choice([word(), str(rng.randint(0, 9999)), "true"])]
    if kind == 6:
        return [word() + str(rng.randint(0, 9999)), "@", word() + "." + word()]
    if kind == 7:  # telephone, book and order numbers
        return ["-".join(str(rng.randrange(10 ** rng.randint(1, 6))) for _ in range(n))]
    if kind == 8:
        return ["https", ":", "/" * 2 + "/".join(word() for _ in range(n)) + "/" + str(rng.randint(0, 99999))]
    return [word().upper() + rng.choice(["", "_" + word().upper(), str(rng.randint(0, 99))])]


def disguised(tokens: list[str], tags: list[int], rng: random.Random) -> tuple[list[str], list[int], bool]:
    """A stretch with a made-up secret (true) or name in place of its first secret
    or, without one, of a token somewhere; other secrets of it become names."""
    out, of, secret = [], [], rng.random() < .5
    at = tags.index(B) if B in tags else rng.randrange(len(tokens))
    for i, (token, tag) in enumerate(zip(tokens, tags)):
        if tag == I:
            continue
        if i != at:
            part, new = ([token], [O]) if tag == O else (["-"], [O])
        else:
            body = made_secret(rng) if secret else made_name(rng)
            lead = list(rng.choice(_LEAD_INS)) if secret or rng.random() < .3 else []
            quote = [rng.choice("\"'")] * (rng.random() < .3)
            part = [*lead, *quote, *body, *quote]
            inside = [B] + [I] * (len(body) - 1) if secret else [O] * len(body)
            new = [O] * (len(lead) + len(quote)) + inside + [O] * len(quote)
        out += part
        of += new
    cut = max(0, min(at - WINDOW // 2, len(out) - WINDOW))
    return out[cut:cut + WINDOW], of[cut:cut + WINDOW], secret


def training_windows(text: str, limit: int = MAX_SECRETS) -> list[tuple[list[str], np.ndarray, list[int]]]:
    """Stretches of a training text: tokens, text features, tags. Those with a
    secret, and some at fixed places, each as it is and twice in disguise (the
    same for equal texts)."""
    secrets = [(s, e) for _, _, e, s in base_spans(text)]
    tokens = list(TOKEN.finditer(text))
    if not tokens:
        return []
    tags, k = [], 0
    ends: list[tuple[int, int]] = sorted(set(secrets))
    previous = None
    for m in tokens:
        while k < len(ends) and ends[k][1] <= m.start():
            k += 1
        inside = k < len(ends) and ends[k][0] < m.end()
        tags.append(O if not inside else I if previous == k else B)
        previous = k if inside else None
    extra = text_features(text)
    centres = [i for i, t in enumerate(tags) if t == B][:limit]
    step = max(1, len(tokens) // 2)
    out = []
    for c in [*centres, *range(step // 2, len(tokens), step)]:
        a = max(0, min(c - WINDOW // 2, len(tokens) - WINDOW))
        part = tokens[a:a + WINDOW]
        out.append(([m[0] for m in part], extra, tags[a:a + WINDOW]))
    rng = random.Random(zlib.crc32(text.encode("utf-8", "surrogatepass")))
    for words, _, of in out[:]:
        for _ in range(2):
            new, new_tags, _ = disguised(words, of, rng)
            out.append((new, extra, new_tags))
    return out


def train(docs: DataFrame, max_train: int = MAX_TRAIN) -> Field:
    """Fit the field on windows of at most ``max_train`` texts."""
    chosen = hashed_rows(id_text(docs), max_train)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in chunks(batches):
            out = [w for t in texts.to_pylist() for w in training_windows(t)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([w[0] for w in out], pa.list_(pa.string())), pa.array([w[1] for w in out], pa.list_(pa.float64())),
                 pa.array([w[2] for w in out], pa.list_(pa.int32()))], names=["tokens", "text", "tags"])

    rows = (chosen.mapInArrow(run, "tokens array<string>, text array<double>, tags array<int>")
            .withColumn("secret", F.exists("tags", lambda t: t == B)))
    order = F.xxhash64("tokens")
    got = (rows.filter("secret").orderBy(order, "tokens").limit(MAX_WINDOWS // 2)
           .unionByName(rows.filter("not secret").orderBy(order, "tokens").limit(MAX_WINDOWS // 2)).collect())
    got.sort(key=lambda r: (r.tokens, r.tags))
    field = Field()
    if not any(r.secret for r in got):
        return field
    types = Types()
    width = WINDOW
    grid, tags = np.zeros((len(got), width), np.int32), np.zeros((len(got), width), np.int64)
    for i, r in enumerate(got):
        grid[i, :len(r.tokens)] = types.of(r.tokens)
        tags[i, :len(r.tags)] = r.tags
    return field.fit(grid, np.array([r.text for r in got]), tags, types.matrix())


def scan(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """(doc_id, spans array<struct<kind,start,end>>) of every row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(field or train(docs))
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(sent.value)
        for doc, text in chunks(batches):
            out = [[{"kind": k, "start": a, "end": b} for k, a, b in scanner.spans(t)] for t in text.to_pylist()]
            yield pa.RecordBatch.from_arrays([doc, pa.array(out, span)], names=["doc_id", "spans"])

    return id_text(docs).mapInArrow(
        run, f"doc_id {id_type(docs)}, spans array<struct<kind:string,start:bigint,end:bigint>>")


def report(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """Per document: n_assign, n_access, n_hex, base_sha256, spans (as text), n_crf."""
    def of(kind):
        return F.filter("spans", lambda s: s["kind"] == kind)

    def text(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    return scan(docs, field).select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(text(F.filter("spans", lambda s: s["kind"] != "crf")), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"))
