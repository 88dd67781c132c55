"""Secret scans: rule matches, and a character convolutional network over every candidate.

The network sees a candidate with the text around it. It is trained here, in numpy, on
labelled findings; its scores are calibrated on held-out findings, and on others the threshold is
set, the largest that keeps a required recall. Long candidates are seen piece by piece. The few
thousand weights are broadcast and one ``mapInArrow`` pass scans the documents.
"""

from __future__ import annotations

import random
import re
import string
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._text import slices

# The rules of the base kinds, in their order.
KEYWORDS = re.compile(r"password|passwd|secret|token|api_?key", re.ASCII | re.IGNORECASE)
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal, so shorter ones need no look
KINDS = ("assign", "access", "hex", "cnn")
#: What the network judges beyond the rules: unbroken runs of 12 or more that mix letters and digits, and all of 20 or
#: more; and passwords, runs of 10 to 64 with letters, digits and marks.
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=.-])(?:(?=[A-Za-z+/_=.-]*[0-9])(?=[0-9+/_=.-]*[A-Za-z])[A-Za-z0-9+/_=.-]{12,}|[A-Za-z0-9+/_=.-]{20,})")
MARKED = re.compile(r"(?<![A-Za-z0-9!@#$%^&*~?_+=.-])(?=[^\s0-9]*[0-9])(?=[^\sA-Za-z]*[A-Za-z])(?=[A-Za-z0-9_+=.-]*[!@#$%^&*~?])[A-Za-z0-9!@#$%^&*~?_+=.-]{10,64}(?![A-Za-z0-9!@#$%^&*~?_+=.-])")
BEFORE, INSIDE, AFTER = 24, 48, 16
WIDTH = BEFORE + INSIDE + AFTER
SYMBOLS = 100
#: Candidates that the network judges at once, so that its arrays don't follow the text's length.
AT_ONCE = 512


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the rule matches, leftmost and without overlaps for each kind."""
    out = []
    if KEYWORDS.search(text):
        out += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    return out


def pieces(start: int, end: int) -> list[tuple[int, int]]:
    """The parts of a candidate that the network sees at once: all of it, or halves that overlap, the last at its end."""
    if end - start <= INSIDE:
        return [(start, end)]
    at = [*range(start, end - INSIDE, INSIDE // 2), end - INSIDE]
    return [(s, s + INSIDE) for s in at]


def window(text: str, start: int, end: int) -> np.ndarray:
    """Symbol codes of a piece and its surroundings; 0 pads."""
    raw = text[max(0, start - BEFORE) : start].rjust(BEFORE, "\0") + text[start:end].ljust(INSIDE, "\0") + text[end : end + AFTER].ljust(AFTER, "\0")
    code = np.frombuffer(raw.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(code == 0, 0, np.where((code >= 32) & (code < 127), code - 31, np.where(code < 32, 97, 98))).astype(np.int64)


@dataclass(frozen=True)
class Network:
    """Embedding, one convolution, pooling inside and around the candidate, one output; plus calibration."""

    embed: np.ndarray
    conv: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    slope: float = 1.0
    shift: float = 0.0
    threshold: float = 0.5

    def hidden(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        k = self.conv.shape[0]
        e = self.embed[x]
        cols = np.concatenate([e[:, j : x.shape[1] - k + 1 + j] for j in range(k)], axis=2)
        z = np.maximum(cols @ self.conv.reshape(-1, self.conv.shape[2]) + self.bias, 0)
        lo, hi = BEFORE, BEFORE + INSIDE - k + 1
        top = z.argmax(axis=1)
        pooled = np.concatenate([np.take_along_axis(z, top[:, None], 1)[:, 0], z[:, lo:hi].mean(axis=1)], axis=1)
        return cols, z, pooled

    def logits(self, x: np.ndarray) -> np.ndarray:
        return self.hidden(x)[2] @ self.out + self.out_bias

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * self.logits(x) + self.shift)))


def labelled_findings(n: int = 12_000, seed: int = 11) -> list[tuple[str, int, int, int]]:
    """Labelled findings (text, start, end, label) from a seeded generator: 1 is a live-looking secret.

    Half are secrets of many shapes after assignments, headers, options or plain words; half are
    look-alikes: long words, identifiers, paths, versions, placeholders, dates and plain numbers.
    """
    rng = random.Random(seed)
    letters, b64, up = string.ascii_letters, string.ascii_letters + string.digits + "+/", string.ascii_uppercase + string.digits
    pick = lambda pool, a, b: "".join(rng.choices(pool, k=rng.randint(a, b)))
    syllables = ["ti", "on", "the", "er", "an", "re", "ing", "st", "le", "pa", "men", "to", "lo", "ver"]
    word = lambda a=1, b=4: "".join(rng.choices(syllables, k=rng.randint(a, b)))
    secrets = [
        lambda: pick(b64, 20, 64),
        lambda: pick(b64, 30, 44) + "=" * rng.randint(0, 2),
        lambda: "ghp_" + pick(letters + string.digits, 36, 36),
        lambda: "sk-" + pick(letters + string.digits, 32, 48),
        lambda: "xoxb-" + pick(string.digits, 10, 12) + "-" + pick(letters + string.digits, 24, 24),
        lambda: "AIza" + pick(letters + string.digits + "_-", 35, 35),
        lambda: pick(up, 20, 40),
        lambda: pick("0123456789abcdef", 24, 64),
        lambda: ".".join("eyJ" * (k == 0) + pick(letters + string.digits + "_-", 20, 40) for k in range(3)),
        lambda: pick(letters + string.digits + "_-", 22, 50),
        lambda: pick(letters + string.digits, 12, 20),
        lambda: pick(letters, 20, 44),
        lambda: "/".join(word(1, 3) for _ in range(rng.randint(1, 4))) + "/" + pick(letters + string.digits, 28, 60) + "/" + word(1, 3),
        lambda: rng.choice(["key", "sig", "access", "live", "prod"]) + rng.choice("-_=") + pick(b64, 24, 90),
        lambda: pick(letters + string.digits + "!@#$%^&*", 10, 24),
        lambda: pick(letters + string.digits, 8, 18) + rng.choice("!@#$%^&*?") + pick(letters + string.digits, 2, 6),
    ]
    others = [
        lambda: word(5, 9) + str(rng.randint(0, 999)),
        lambda: "_".join(word(1, 3) for _ in range(rng.randint(3, 5))) + str(rng.randint(1, 9)),
        lambda: "/".join(word(1, 3) for _ in range(rng.randint(3, 6))) + f"/v{rng.randint(1, 9)}",
        lambda: f"{rng.randint(1990, 2030)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}T{rng.randint(0, 23):02d}-00Z",
        lambda: f"{word(2, 3)}-{rng.randint(0, 20)}.{rng.randint(0, 20)}.{rng.randint(0, 20)}-{word(1, 2)}.tar.gz",
        lambda: "x" * rng.randint(14, 30) + "1",
        lambda: "your_" + rng.choice(["token", "api_key", "secret"]) + "_here_" + str(rng.randint(1, 9)),
        lambda: "example" + word(2, 4) + str(rng.randint(10, 9999)),
        lambda: f"mail{rng.randint(0, 99)}.{word(2, 4)}.example.com",
        lambda: "".join(w.capitalize() for w in (word(2, 3), word(2, 3), word(2, 3))) + str(rng.randint(0, 99)),
        lambda: "-".join(word(1, 3) for _ in range(5)) + "-" + str(rng.randint(1, 99)),
        lambda: "=" * rng.randint(14, 40) + "1a",
        lambda: rng.choice("=-_.") * rng.randint(20, 80),
        lambda: word(9, 14).capitalize(),
        lambda: rng.choice("-_./").join(word(1, 4) for _ in range(rng.randint(4, 12))),
        lambda: "".join(rng.choices(string.digits, k=rng.randint(20, 30))),
        lambda: "-".join("".join(rng.choices(string.digits, k=rng.randint(2, 5))) for _ in range(rng.randint(4, 6))),
        lambda: f"{word(2, 4)}.{word(2, 3)}{rng.randint(1, 999)}",
        lambda: f"{word(1, 2)}{rng.randint(1, 99)}-{word(1, 2)}{rng.randint(1, 99)}.{word(1, 2)}.{rng.choice(['com', 'org', 'net'])}/{word(1, 3)}",
        lambda: f"{rng.randint(1, 255)}.{rng.randint(0, 255)}.{rng.randint(0, 255)}.{rng.randint(0, 255)}/{rng.choice(['a', 'x'])}{rng.randint(8, 32)}",
        lambda: f"{word(1, 3)}{rng.choice(['.', '_', ''])}{word(1, 2)}{rng.randint(1, 99)}@{word(2, 3)}.{rng.choice(['com', 'org', 'net'])}",
        lambda: f"{word(2, 4)}.html#{word(1, 3)}-{rng.randint(1, 40)}",
        lambda: f"{word(2, 4)}?{word(1, 2)}={rng.randint(1, 99)}&{word(1, 2)}={word(1, 2)}",
        lambda: f"{word(2, 4)}{rng.randint(1, 99)}{rng.choice(['!!', '?!', '...?', '!'])}",
        lambda: f"{word(1, 2).capitalize()}-{word(1, 2)}-{rng.randint(10, 100)}%-{word(1, 2)}",
        lambda: "_".join(word(1, 3) for _ in range(rng.randint(3, 6))),
        lambda: ".".join(word(1, 3).capitalize() if rng.random() < 0.4 else word(1, 3) for _ in range(rng.randint(3, 6))),
        lambda: "".join(word(1, 3).capitalize() for _ in range(rng.randint(3, 6))),
        lambda: f"{word(1, 3)}." * rng.randint(0, 1) + "_".join(word(1, 3).upper() for _ in range(rng.randint(2, 5))) + rng.choice(["", "", str(rng.randint(0, 999))]),
        lambda: f"{word(1, 2)}{rng.choice('-_.')}" * rng.randint(0, 1) + f"{rng.randint(1990, 2030)}{(m := rng.choice(['-', '', '.']))}{rng.randint(1, 12):02d}{m}{rng.randint(1, 28):02d}{rng.choice(['T', '-', '_'])}{rng.randint(0, 23):02d}{m}{rng.randint(0, 59):02d}{rng.choice(['', '.', '-', '_'])}{word(1, 3)}.{rng.choice(['gz', 'log', 'csv', 'zip', 'bak'])}",
        lambda: "--" + "-".join(word(1, 3) for _ in range(rng.randint(1, 4))) + f"={rng.choice([str(rng.randint(0, 999)), word(1, 2)])}",
        lambda: f"/{word(1, 2)}/{word(1, 2)}/{word(1, 3)}{rng.randint(2, 9)}.{rng.randint(0, 19)}/{word(2, 4)}_{word(1, 3)}.{rng.choice(['py', 'so', 'txt', 'json', 'md'])}",
    ]
    prefix = ["", "", "key: ", "Authorization: Bearer ", "export KEY=", '"value": "', "--auth ", "use ", "see ", "file ", "id ", "version "]
    out = []
    for k in range(n):
        label = k % 2
        before = " ".join(word() for _ in range(rng.randint(0, 8))) + " " + rng.choice(prefix)
        value = rng.choice(secrets if label else others)()
        after = rng.choice(["", '"', " ", ". ", ", "]) + " ".join(word() for _ in range(rng.randint(0, 6)))
        out.append((before + value + after, len(before), len(before) + len(value), label))
    return out


def train(findings: list[tuple[str, int, int, int]], recall: float = 0.98, epochs: int = 6, seed: int = 3, size: int = 8, filters: int = 24, kernel: int = 5) -> Network:
    """Fit on three fifths of the findings, calibrate on the fourth, and set the threshold, which keeps ``recall``, on the last."""
    rng = np.random.default_rng(seed)
    some = [(t, *(p := pieces(s, e))[int(rng.integers(len(p)))]) for t, s, e, _ in findings]
    x = np.stack([window(*f) for f in some])
    y = np.array([f[3] for f in findings], float)
    order = rng.permutation(len(y))
    held, last, fit = order[: len(y) // 5], order[len(y) // 5 : 2 * len(y) // 5], order[2 * len(y) // 5 :]
    p = {"embed": rng.normal(0, 0.5, (SYMBOLS, size)), "conv": rng.normal(0, (2 / (kernel * size)) ** 0.5, (kernel, size, filters)), "bias": np.zeros(filters), "out": rng.normal(0, 0.1, 2 * filters), "out_bias": np.zeros(())}
    m, v, step = {k: np.zeros_like(a) for k, a in p.items()}, {k: np.zeros_like(a) for k, a in p.items()}, 0
    lo, hi = BEFORE, BEFORE + INSIDE - kernel + 1
    for _ in range(epochs):
        for at in np.array_split(rng.permutation(fit), max(1, len(fit) // 64)):
            net = Network(**p)
            cols, z, pooled = net.hidden(x[at])
            g = (1 / (1 + np.exp(-(pooled @ p["out"] + p["out_bias"]))) - y[at]) / len(at)
            gp = g[:, None] * p["out"]
            gz = np.zeros_like(z)
            np.put_along_axis(gz, z.argmax(axis=1)[:, None], gp[:, None, :filters], 1)
            gz[:, lo:hi] += gp[:, None, filters:] / (hi - lo)
            gz *= z > 0
            gcols = gz @ p["conv"].reshape(-1, filters).T
            ge = np.zeros((len(at), WIDTH, size))
            for j in range(kernel):
                ge[:, j : WIDTH - kernel + 1 + j] += gcols[:, :, j * size : (j + 1) * size]
            gembed = np.zeros_like(p["embed"])
            np.add.at(gembed, x[at], ge)
            grads = {"embed": gembed, "conv": np.einsum("nlc,nlf->cf", cols, gz, optimize=True).reshape(kernel, size, filters), "bias": gz.sum((0, 1)), "out": pooled.T @ g, "out_bias": g.sum()}
            step += 1
            for k, d in grads.items():
                m[k] = 0.9 * m[k] + 0.1 * d
                v[k] = 0.999 * v[k] + 0.001 * d * d
                p[k] = p[k] - 0.01 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    net = Network(**p)
    score = net.logits(x[held])
    a, b = 1.0, 0.0
    for _ in range(200):  # Platt scaling by gradient steps
        q = 1 / (1 + np.exp(-(a * score + b)))
        a, b = a - 0.05 * float(np.mean((q - y[held]) * score)), b - 0.5 * float(np.mean(q - y[held]))
    prob = np.sort(1 / (1 + np.exp(-(a * net.logits(x[last[y[last] == 1]]) + b))))
    return Network(**p, slope=a, shift=b, threshold=float(prob[int((1 - recall) * len(prob))]) if len(prob) else 0.5)


@lru_cache(maxsize=1)
def default_network() -> Network:
    return train(labelled_findings())


def scan_text(text: str | None, net: Network) -> list[tuple[int, str, int, float | None]]:
    """(start, kind, end, probability) by start, then kind; rule matches carry the network's opinion too.

    A span's probability is that of its likeliest piece.
    """
    text = text or ""
    base = base_spans(text)
    taken = sorted((s, e) for s, _, e in base)
    starts, reach = [s for s, _ in taken], [*accumulate((e for _, e in taken), max)]
    # a candidate goes only if one rule match holds all of it
    spans = {m.span() for p in (CANDIDATE, MARKED) for m in p.finditer(text)}
    more = [(s, "cnn", e) for s, e in sorted(spans) if not (k := bisect_right(starts, s)) or reach[k - 1] < e]
    every = base + more
    if not every:
        return []
    score = np.zeros(len(every))
    seen = ((k, p) for k, (s, _, e) in enumerate(every) for p in pieces(s, e))
    while part := list(islice(seen, AT_ONCE)):
        np.maximum.at(score, [k for k, _ in part], net.probability(np.stack([window(text, *p) for _, p in part])))
    found = [(s, k, e, float(p)) for (s, k, e), p in zip(every, score) if k != "cnn" or p >= net.threshold]
    return sorted(found, key=lambda f: (f[0], KINDS.index(f[1])))


def scan_secrets(docs: DataFrame, net: Network | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and spans (array of kind, start, end, probability; code points, end exclusive) of every row.

    Null counts as empty and has no spans; repeated rows repeat their result.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(net or default_network())
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch):
                rows = [[{"kind": k, "start": s, "end": e, "probability": p} for s, k, e, p in scan_text(t.as_py(), shared.value)] for t in b.column(1)]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.list_(span))], ["doc_id", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, spans array<struct<kind:string,start:bigint,end:bigint,probability:double>>")


def digest(found: DataFrame) -> DataFrame:
    def line(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(line(F.filter("spans", lambda s: s["kind"] != "cnn")), 256).alias("base_sha256"),
        line(F.col("spans")).alias("spans"),
    )
