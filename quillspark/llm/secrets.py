"""Secret scans: three base patterns, and a character convolutional network in numpy over every other candidate and
its context.

A candidate is any run of at least 16 of the characters A-Za-z0-9+/_.=@:- or, where base findings overlap such a run,
each part of at least 16 that they leave. The network sees windows of 48 characters, 24 apart and one at the end, so that
all of a candidate is seen, each with 24 before and 8 after it, as character classes; one window over the threshold makes
the candidate a finding.

It is trained on labelled findings of two kinds:
- of the table itself, at most SAMPLE of a label (those of the smallest hashes): secret are the base findings, half of
  them in the context of a run that isn't secret, so that the run and not the word before it is learnt; not secret are
  candidates made of words and numbers alone (`plain`). Candidates that are neither stay unlabelled;
- made by rule: keys, tokens and connection strings, alone and behind hosts and paths, against words, numbers, rules,
  URLs, addresses, dates, UUIDs, integrity hashes, embedded images and digests of files named as such.
Training, calibration, threshold and the reported figures each have findings of their own. The threshold is, of all that
keep the wanted recall on its findings, the most precise, and of such the lowest.
All of it is a map over Arrow batches: no shuffle; the model has some 10,000 weights whatever the corpus.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, restored, small_batches

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=@:-]{16,}")
KINDS = ("assign", "access", "hex", "cnn")
SHORTEST = 16
BEFORE, INSIDE, AFTER = 24, 48, 8
STEP = INSIDE // 2
#: Findings of each label that the network is fitted on, of a table.
SAMPLE = 2000
WIDTH = BEFORE + INSIDE + AFTER

Span = tuple[int, int, int]  # start, kind's place in KINDS, end


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind; ends are exclusive, in code points."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, base: list[Span]) -> list[tuple[int, int]]:
    """Every run of candidate characters, or the parts of it of at least SHORTEST characters between base findings."""
    out, at = [], 0
    ends = np.maximum.accumulate([e for _, _, e in base]).tolist() if base else []
    for m in CANDIDATE.finditer(text):
        s, e = m.span()
        while at < len(base) and ends[at] <= s:
            at += 1
        i = at
        while i < len(base) and base[i][0] < e:
            if base[i][0] - s >= SHORTEST:
                out.append((s, base[i][0]))
            s = max(s, base[i][2])
            i += 1
        if e - s >= SHORTEST:
            out.append((s, e))
    return out


def windows(start: int, end: int) -> list[tuple[int, int]]:
    """What encode is given for a candidate: its start, and of a longer one also all windows that follow."""
    last = end - INSIDE
    return [(start, end), *((a, a + INSIDE) for a in range(start + STEP, last, STEP)), *([(last, end)] if last > start else [])]


def _class_table() -> np.ndarray:
    """Code point below 128 to class: each letter and digit pooled with its like but hex letters, punctuation apart."""
    table = np.full(129, 1)
    for i in range(128):
        c = chr(i)
        table[i] = 2 + (0 if c in "abcdef" else 1 if c.islower() else 2 if c in "ABCDEF" else 3 if c.isupper() else 4 if c.isdigit() else 5 + "+/_.=@:-\"' \n,;()<>%&?#".find(c) if c in "+/_.=@:-\"' \n,;()<>%&?#" else -1)
    return table


CLASSES = _class_table()
N_CLASSES = int(CLASSES.max()) + 1


def encode(text: str, start: int, end: int) -> np.ndarray:
    """Character classes of a candidate and its context; 0 where there is none."""
    out = np.zeros(WIDTH, np.int64)
    inside = text[start : min(end, start + INSIDE)]
    for part, at in ((text[max(0, start - BEFORE) : start], BEFORE - min(BEFORE, start)), (inside, BEFORE), (text[end : end + AFTER], BEFORE + INSIDE)):
        if part:
            codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
            out[at : at + len(codes)] = CLASSES[np.minimum(codes, 128)]
    return out


class Network:
    """Embedding by class and zone, one convolution of width 5, max and mean pooling, one hidden layer, logistic output."""

    FILTERS, HIDDEN, SPAN = 24, 16, 5

    def __init__(self, seed: int):
        r = np.random.default_rng(seed)
        # zones: before, inside, after; so that a filter knows where it looks
        self.conv = r.normal(0, 0.3, (self.SPAN, N_CLASSES * 3, self.FILTERS))
        self.bias = np.zeros(self.FILTERS)
        self.w1 = r.normal(0, 0.2, (2 * self.FILTERS + 2, self.HIDDEN))
        self.b1 = np.zeros(self.HIDDEN)
        self.w2 = r.normal(0, 0.2, self.HIDDEN)
        self.b2 = 0.0
        self.shift, self.scale = 0.0, 1.0

    ZONE = np.repeat([0, 1, 2], [BEFORE, INSIDE, AFTER]) * N_CLASSES

    def pooled(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        codes = x + self.ZONE
        wide = WIDTH - self.SPAN + 1
        z = np.broadcast_to(self.bias, (len(x), wide, self.FILTERS)).copy()
        for k in range(self.SPAN):
            z += self.conv[k][codes[:, k : k + wide]]
        a = np.maximum(z, 0)
        extra = np.stack([(x[:, BEFORE : BEFORE + INSIDE] > 0).mean(1), [_variety(row) for row in x]], axis=1)
        return np.concatenate([a.max(1), a.mean(1), extra], axis=1), z, codes

    def logits(self, x: np.ndarray) -> np.ndarray:
        f, _, _ = self.pooled(x)
        return np.maximum(f @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Calibrated by Platt's scaling on held-out findings."""
        return 1 / (1 + np.exp(-np.clip(self.shift + self.scale * self.logits(x), -40, 40)))

    def fit(self, x: np.ndarray, y: np.ndarray, seed: int, rounds: int = 5, rate: float = 0.003) -> None:
        r = np.random.default_rng(seed)
        params = [self.conv, self.bias, self.w1, self.b1, self.w2]
        m, v, b2m, b2v, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0.0, 0.0, 0
        wide = WIDTH - self.SPAN + 1
        for _ in range(rounds):
            order = r.permutation(len(x))
            for i in range(0, len(x), 64):
                xb, yb = x[order[i : i + 64]], y[order[i : i + 64]]
                f, z, codes = self.pooled(xb)
                h = f @ self.w1 + self.b1
                out = np.maximum(h, 0) @ self.w2 + self.b2
                d = (1 / (1 + np.exp(-np.clip(out, -40, 40))) - yb) / len(xb)
                dh = np.outer(d, self.w2) * (h > 0)
                df = dh @ self.w1.T
                a = np.maximum(z, 0)
                dz = np.repeat(df[:, None, self.FILTERS : 2 * self.FILTERS] / wide, wide, axis=1)
                top = a.argmax(1)
                np.add.at(dz, (np.arange(len(xb))[:, None], top, np.arange(self.FILTERS)[None, :]), df[:, : self.FILTERS])
                dz *= z > 0
                seen = np.eye(N_CLASSES * 3)[codes]
                dconv = np.stack([np.tensordot(seen[:, k : k + wide], dz, ([0, 1], [0, 1])) for k in range(self.SPAN)])
                t += 1
                for j, g in enumerate([dconv, dz.sum((0, 1)), f.T @ dh, dh.sum(0), np.maximum(h, 0).T @ d]):
                    m[j] = 0.9 * m[j] + 0.1 * g
                    v[j] = 0.999 * v[j] + 0.001 * g * g
                    params[j] -= rate * (m[j] / (1 - 0.9**t)) / (np.sqrt(v[j] / (1 - 0.999**t)) + 1e-8)
                b2m, b2v = 0.9 * b2m + 0.1 * d.sum(), 0.999 * b2v + 0.001 * d.sum() ** 2
                self.b2 -= rate * (b2m / (1 - 0.9**t)) / (np.sqrt(b2v / (1 - 0.999**t)) + 1e-8)

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        z, a, b = self.logits(x), 1.0, 0.0
        for _ in range(200):
            p = 1 / (1 + np.exp(-np.clip(a * z + b, -40, 40)))
            a -= 0.05 * np.mean((p - y) * z)
            b -= 0.05 * np.mean(p - y)
        self.scale, self.shift = a, b


def _variety(row: np.ndarray) -> float:
    """How often neighbours inside the candidate change class."""
    inside = row[BEFORE : BEFORE + INSIDE]
    inside = inside[inside > 0]
    return float(np.mean(inside[1:] != inside[:-1])) if len(inside) > 1 else 0.0


def labelled_findings(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """n findings made by rule, each an encoded window of a candidate with context, and whether it is a secret.

    Of a secret it is the window that holds most of the key (which begins at the third value, where there is one), of
    others any.
    """
    r = np.random.default_rng(seed)
    digits, lower = "0123456789", "abcdefghijklmnopqrstuvwxyz"
    upper, mixed = lower.upper(), digits + lower + lower.upper()
    pick = lambda chars, k: "".join(chars[i] for i in r.integers(0, len(chars), k))
    one = lambda xs: xs[int(r.integers(0, len(xs)))]
    word = lambda: pick(lower, int(r.integers(2, 9)))
    name = lambda: word().capitalize() if r.random() < 0.3 else word()
    prose = lambda k: " ".join(name() for _ in range(k)) + one([" ", ". ", ", ", "\n"])
    size = lambda a, b: int(r.integers(a, b))
    letters = lower + upper
    key = lambda: one(["", "", "ghp_", "gho_", "sk_live_", "glpat-", "sk-"]) + pick(one([mixed, mixed, letters]), size(20, 44))
    path = lambda a, b: one("///.-_").join(word() for _ in range(size(a, b)))
    host = lambda: f"http{one(['', 's'])}://{one(['www.', '', word() + '.'])}{word()}.{one(['com', 'org', 'net'])}"
    behind = lambda lead, own, rest: (prose(2), lead + own + rest, len(lead))
    secret = [
        lambda: ("key = ", pick(mixed, size(24, 48))),
        lambda: (one(["auth: Bearer ", "bearer ", "Authorization "]), pick(mixed + "-_", size(24, 60)) + "." + pick(mixed + "-_", size(20, 40))),
        lambda: (prose(3), one(["ghp_", "gho_", "sk_live_", "xoxb-", "glpat-", "sk-", "pk_live_"]) + pick(mixed, size(20, 40))),
        lambda: (one(["private ", "credential=", "pwd=", "access ", "key: "]), pick(mixed + "+/", size(28, 64)) + one(["", "=", "=="])),
        lambda: (one(["db ", "url: ", "dsn="]), f"postgres://{word()}:{pick(mixed, size(10, 20))}@{word()}.{word()}:5432/{word()}"),
        lambda: (prose(3), "AIza" + pick(mixed + "-_", 35)),
        lambda: (prose(2), pick(mixed, size(32, 48))),
        lambda: behind(f"http{one(['', 's'])}://{word()}:", key(), f"@{word()}.{one(['com', 'org', 'net'])}/{path(1, 6)}"),
        lambda: behind(f"{host()}/{path(3, 16)}{one(['/', ':', '=', '/key='])}", key(), one(["", "", "/", "/" + path(1, 5)])),
        lambda: behind(f"{path(2, 16)}{one(['/', ':', '=', '/auth='])}", key(), one(["", "", "/" + path(1, 4)])),
        lambda: (one(["key = ", "bearer ", "private ", "credential=", "key: ", prose(3)]), pick(letters, size(24, 48))),
    ]
    clean = [
        lambda: (prose(4), "-".join(word() for _ in range(size(3, 6))) + one(["1", "2", "24"])),
        lambda: (prose(3), f"{word()}.{size(10, 99)}@mail{size(0, 9)}.example.com"),
        lambda: (one(["see ", "at ", prose(2)]), f"http{one(['', 's'])}://{one(['www.', ''])}{word()}.{one(['com', 'org', 'net'])}/{word()}/{size(1, 999)}/{word()}{one(['.html', '', '/'])}"),
        lambda: (prose(3), f"20{size(10, 30)}-{size(10, 13)}-{size(10, 29)}T{size(10, 24)}:{size(10, 60)}:{size(10, 60)}Z"),
        lambda: (one(["sha1 ", "commit ", "md5: ", "etag "]), pick(digits + "ABCDEF", size(8, 12)) + "-" + pick(digits, 8)),
        lambda: (prose(2), f"{word()}_{word()}_{word()}_{size(1, 20)}"),
        lambda: (prose(3), f"{word()}.{size(10, 99)}.{word()}.{word()}"),
        lambda: (prose(2), f"{word()}/{word()}/{word()}{size(1, 9)}.{one(['py', 'txt', 'csv'])}"),
        lambda: (prose(3), f"{word()}{word()}{word()}{word()[:3]}{size(0, 99)}"),
        lambda: (prose(2), f"{size(1000, 9999)}-{size(1000, 9999)}-{size(1000, 9999)}-{size(1000, 9999)}a"),
        lambda: (prose(2), f"v{size(1, 9)}.{size(0, 20)}.{size(0, 20)}-{one(['beta', 'alpha', 'release'])}.{size(1, 9)}"),
        lambda: (prose(2), name() + "=" * size(10, 20) + str(size(1, 9))),
        lambda: (prose(2), f"{host()}/{path(3, 24)}{one(['', '/', '.html', '-' + str(size(1, 9999))])}"),
        lambda: (prose(2), f"{host()}/20{size(10, 30)}/{size(10, 13)}/{size(10, 29)}/{path(2, 16)}"),
        lambda: (prose(2), path(4, 24)),
        lambda: (prose(2), one("/._-").join(f"{word()}{one(['', '', size(0, 99)])}" for _ in range(size(4, 16)))),
        lambda: (prose(3), (pick(lower, size(16, 30)).capitalize() if r.random() < 0.3 else pick(lower, size(16, 30)))),
        lambda: (prose(2), "".join(pick(lower, size(4, 9)).capitalize() for _ in range(size(3, 6)))),
        lambda: (prose(2), "_".join(word().upper() for _ in range(size(3, 8)))),
        lambda: (prose(2), "".join(one([a + b, a, a]) for a, b in [(one("=-_.:+/"), one("=-_.:+/"))] for _ in range(size(16, 80)))),
        lambda: (prose(2), "-".join(pick(digits, size(4, 9)) for _ in range(size(3, 9)))),
        lambda: (prose(2), pick(digits, size(16, 40))),
        lambda: (prose(2), f"{word()}.{word()}@{word()}{one(['.', '-'])}{word()}.example.{one(['com', 'org'])}"),
        lambda: (prose(2), (word() + word()) * size(4, 12)),
        lambda: (one(["integrity=", prose(2), "hash "]), one(["sha256-", "sha384-", "sha512-", "sha256:"]) + pick(mixed + "+/", size(42, 88)) + one(["", "=", "=="])),
        lambda: (one(["id ", "uuid: ", prose(2)]), "-".join(pick(digits + "abcdef", k) for k in (8, 4, 4, 4, 12))),
        lambda: (one(["src=", prose(2)]), "data:image/" + one(["png", "jpeg", "gif"])),
        lambda: (f"data:image/{one(['png', 'jpeg'])};base64,", pick(mixed + "+/", size(300, 900))),
    ]
    x, y = np.zeros((n, WIDTH), np.int64), np.zeros(n)
    for i in range(n):
        y[i] = r.random() < 0.5
        before, run, *at = one(secret if y[i] else clean)()
        quote = one(["", "", '"', "'"])
        text = prose(3) + before + quote
        seen = windows(len(text), len(text) + len(run))
        core = len(text) + (at[0] if at else 0)
        seen = max(seen, key=lambda w: min(w[0] + INSIDE, core + 24) - max(w[0], core)) if y[i] else one(seen)
        x[i] = encode(text + run + quote + one([" ", "\n", ".", ", "]) + prose(2), *seen)
    return x, y


PLAIN = re.compile(r"(?:[A-Za-z][a-z]{2,24}|[A-Z]{2,24}|[0-9]+)(?:[+/_.=@:-]+|$|(?=[A-Z])|(?<=[a-z])(?=[0-9]))")


def plain(run: str) -> bool:
    """Whether a run is words of three letters or more (small, capital or capitalised) and numbers, with signs between."""
    return not PLAIN.sub("", run.strip("+/_.=@:-"))


def _labelled(text: str | None) -> list[tuple[int, np.ndarray]]:
    """Windows of a text's findings that have a label: 1 for base findings, 0 for plain candidates."""
    text = text or ""
    base = base_spans(text)
    out = [(1, encode(text, *w)) for s, k, e in base for w in windows(max(s, e - len(VALUE.search(text, s, e)[0])) if k == 0 else s, e)[:1]]
    return out + [(0, encode(text, *w)) for s, e in candidates(text, base) if plain(text[s:e]) for w in windows(s, e)[-1:]]


VALUE = re.compile(r"[A-Za-z0-9+/_.=-]+\Z")


def table_findings(df: DataFrame, text_col: str, limit: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Labelled windows of a table: of each label those of the smallest hashes, `limit` at most."""
    rows = small_batches(df).select(F.col(text_col).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[dict[bytes, bytes]] = [{}, {}]

        def smallest() -> None:
            for k, own in enumerate(best):
                best[k] = dict(sorted(own.items())[:limit])

        for batch in batches:
            for x in batch.column(0):
                for label, window in _labelled(x.as_py()):
                    data = window.astype(np.uint8).tobytes()
                    best[label][hashlib.blake2b(data, digest_size=8).digest()] = data
            if max(map(len, best)) > 4 * limit:
                smallest()
        smallest()
        rows = [(k, h, d) for k, own in enumerate(best) for h, d in own.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.binary(), pa.binary()))], ["label", "hash", "data"])

    found = rows.mapInArrow(work, "label int, hash binary, data binary").dropDuplicates(["label", "hash"])
    own = [r for label in (0, 1) for r in found.where(F.col("label") == label).orderBy("hash").limit(limit).collect()]
    x = np.array([np.frombuffer(r["data"], np.uint8) for r in own], np.int64).reshape(-1, WIDTH)
    return x, np.array([r["label"] for r in own], float)


def _moved(x: np.ndarray, y: np.ndarray, seed: int) -> np.ndarray:
    """x with half of the secrets in the context of one of the others."""
    r, x, clean = np.random.default_rng(seed), x.copy(), x[y == 0]
    some = np.flatnonzero((y == 1) & (r.random(len(y)) < 0.5))
    if len(clean):
        x[some, :BEFORE] = clean[r.integers(0, len(clean), len(some)), :BEFORE]
        x[some, BEFORE + INSIDE :] = clean[r.integers(0, len(clean), len(some)), BEFORE + INSIDE :]
    return x


def trained(table: tuple[np.ndarray, np.ndarray], recall: float = 0.95, seed: int = 7) -> tuple[Network, float, dict]:
    """The network, its threshold, and recall and precision on findings held out from both, made and of the table."""
    r = np.random.default_rng(seed)
    parts = []
    for x, y in (labelled_findings(15000, seed), (_moved(*table, seed), table[1])):
        order = r.permutation(len(x))
        parts.append([(x[i], y[i]) for i in np.split(order, [int(len(x) * share) for share in (0.7, 0.8, 0.9)])])
    fit, calibration, choice, held = ([np.concatenate([p[i][j] for p in parts]) for j in (0, 1)] for i in range(4))
    net = Network(seed)
    net.fit(*fit, seed)
    net.calibrate(*calibration)
    p, true = net.probability(choice[0]), choice[1] == 1
    cuts = np.sort(p[true])[: int((1 - recall) * true.sum()) + 1]  # all that keep the recall
    threshold = float(max(cuts, key=lambda t: (true[p >= t].mean(), -t)))
    quality = {"held out": len(held[0])}
    for name, (x, y) in (("", held), ("table ", parts[1][3])):
        found, truth = net.probability(x) >= threshold, y == 1
        both = float((found & truth).sum())
        quality |= {f"{name}secrets": int(truth.sum()), f"{name}recall": both / max(1, truth.sum()), f"{name}precision": both / max(1, found.sum())}
    return net, threshold, quality


@functools.lru_cache(4)
def _cached(x: bytes, y: bytes, recall: float, seed: int) -> tuple[Network, float, dict]:
    return trained((np.frombuffer(x, np.uint8).astype(np.int64).reshape(-1, WIDTH), np.frombuffer(y, np.uint8).astype(float)), recall, seed)


def model(df: DataFrame, text_col: str = "text", recall: float = 0.95, seed: int = 7) -> tuple[Network, float, dict]:
    """trained() on the findings of a table; kept for tables of the same findings."""
    x, y = table_findings(df, text_col)
    return _cached(x.astype(np.uint8).tobytes(), y.astype(np.uint8).tobytes(), recall, seed)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _scan(text: str | None, net: Network, threshold: float) -> tuple[list[Span], list[Span]]:
    """Base findings, and all."""
    text = text or ""
    base = base_spans(text)
    seen = [(w, run) for run in candidates(text, base) for w in windows(*run)]
    more: set[Span] = set()
    for i in range(0, len(seen), 256):
        part = seen[i : i + 256]
        p = net.probability(np.stack([encode(text, *w) for w, _ in part]))
        more |= {(s, 3, e) for (_, (s, e)), x in zip(part, p, strict=True) if x >= threshold}
    return base, sorted([*base, *more])


SPANS = "array<struct<kind:string,start:long,end:long>>"


def _map(df: DataFrame, id_col: str, text_col: str, recall: float, schema: str, make) -> DataFrame:
    net, threshold, _ = model(df, text_col, recall)
    shared = df.sparkSession.sparkContext.broadcast((vars(net), threshold))
    rows = small_batches(df).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, threshold = shared.value
        net = restored(Network, state)
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                texts = part.column(1).to_pylist()
                arrays = make(texts, [_scan(t, net, threshold) for t in texts])
                yield pa.RecordBatch.from_arrays([part.column(0), *arrays.values()], ["id", *arrays])

    return rows.mapInArrow(work, f"id {kind}, {schema}").withColumnRenamed("id", id_col)


def find_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", recall: float = 0.95) -> DataFrame:
    """For each row its id and findings (kind, start, end in code points, end exclusive), by start and kind.

    A null text counts as empty; rows with null or equal ids each give a row; texts of any length are whole; findings
    that begin together are in the order of KINDS; other columns are not looked at. An empty table gives no rows.
    """

    def make(texts, scans):
        rows = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans] for _, spans in scans]
        return {"spans": pa.array(rows, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))}

    return _map(df, id_col, text_col, recall, f"spans {SPANS}", make)


def masked(text: str | None, spans: list[Span], mask: str) -> str | None:
    """text with each finding, or run of overlapping findings, replaced by mask."""
    if not text or not spans:
        return text
    out, at = [], 0
    for s, _, e in spans:
        if s >= at:
            out += [text[at:s], mask]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", recall: float = 0.95, mask: str = "[SECRET]") -> DataFrame:
    """id and text with all findings masked; null texts stay null; rows with null or equal ids each give a row."""

    def make(texts, scans):
        return {"text": pa.array([masked(t, spans, mask) for t, (_, spans) in zip(texts, scans, strict=True)], pa.string())}

    return _map(df, id_col, text_col, recall, "text string", make).withColumnRenamed("text", text_col)


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    def make(texts, scans):
        base = [b for b, _ in scans]
        return {
            **{f"n_{k}": pa.array([sum(x[1] == i for x in b) for b in base], pa.int64()) for i, k in enumerate(KINDS[:3])},
            "base_sha256": pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b in base]),
            "spans": pa.array([joined(spans) for _, spans in scans]),
        }

    return _map(read(spark, sf_dir, "documents"), "doc_id", "text", 0.95, "n_assign long, n_access long, n_hex long, base_sha256 string, spans string", make)
