"""Secret scans: candidates by pattern, false positives removed by a random forest.

Candidates are values assigned to a credential name and passwords of addresses,
whatever their length and characters, and elsewhere runs of 16 or more
characters of which credentials are made. The forest judges one by its length, its character transitions (how likely they
are in the words of the corpus, how often the kind of character changes), how
much of it dictionary words cover, whether it is part of a path, address, login
or host name, and by the words next to it.

Words and letter pairs are counted over all documents. The forest is trained from
labelled findings: those that the caller has, or by default
those that ``weak_findings`` labels by plain rules, together with made-up ones
from a seeded generator. The sample is bounded: ``SAMPLE_DOCUMENTS`` documents
that hold an assignment to a credential name and as many others, and at most
``SAMPLE`` findings of each label. Every whole text is scanned.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import math
import random
import re
import string
from collections import Counter
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from deedlens.llm.arrow import texts
from deedlens.sources.scratch import stored

SAMPLE_DOCUMENTS = 2_000
SAMPLE = 5_000
#: A word of the dictionary occurs so often at least, and is one in so many of all words of the documents.
LEAST, ONE_IN = 3, 2_000_000
#: Words that made-up findings are put together from, at most.
MADE_OF = 5_000
TREES, DEPTH = 50, 8
SEED = 42
THRESHOLD = 0.5
MASK = "[SECRET]"
#: Characters before a candidate, and behind it, that are its neighbourhood.
NEAR = 48

_CANDIDATE = re.compile(r"[A-Za-z0-9_+/=.~\-]{16,}")
_CREDENTIAL = re.compile(
    r"(?:token|secret|passw(?:or)?d|passphrase|pwd|api[_ -]?key|access[_ -]?key|private[_ -]?key|auth|bearer|credential)s?\b",
    re.I,
)
_HARMLESS = re.compile(
    r"\b(?:commit|sha(?:1|256)?|md5|checksum|digest|hash|uuid|guid|version|build|rev(?:ision)?|file|path|url|href|example)\b", re.I
)
_ASSIGNED = re.compile(r"[=:]\s*[\"']?\Z")
# A name before an assignment sign, looked for in the NAMED characters before the sign.
NAMED = 100
_NAMED = re.compile(
    r"(?:(?:token|secret|passw(?:or)?d|passphrase|pwd|api[_ -]?key|access[_ -]?key|private[_ -]?key|credential)s?[\w-]{0,40}"
    r"|(?:auth|authorization|bearer)s?)[\"'`\])]{0,2}\s*\Z",
    re.I,
)
_PARTS = ("token", "secret", "pass", "pwd", "key", "credential", "auth", "bearer")
_SIGN = re.compile(r"[=:]+>?\s*")
_SCHEME = re.compile(r"(?:bearer|basic|token|digest)\s+(?=\S)", re.I)
_QUOTED = re.compile(r"[bruf]{0,2}([\"'`])((?:\\.|(?!\1)[^\\\n])+)\1", re.I)
# Four groups of four letters are a password that is shown with blanks.
_BARE = re.compile(r"[a-z]{4}(?: [a-z]{4}){3}(?![^\s,;.)\]}])|\S+")
_LOGIN = re.compile(r"://[^\s/:@\"'<>]*:")
_LOGIN_END = re.compile(r"[\s\"'<>]|://")
_ASSIGNMENT = r"(?i)(token|secret|passw(or)?d|pwd|api[_ -]?key|access[_ -]?key|private[_ -]?key)\w*['\"]?\s*[=:]"

FEATURES = [
    "length",
    "digits",
    "upper",
    "kinds",
    "changes",
    "entropy",
    "transition",
    "dictionary",
    "path",
    "address",
    "credential",
    "harmless",
    "assigned",
    "quoted",
    "special",
    "login",
]


def _assigned(text: str) -> list[tuple[int, int, int]]:
    """Start of the name, start and end of each value that is assigned to a credential name."""
    found: list[tuple[int, int, int]] = []
    closed = run = 0
    for sign in _SIGN.finditer(text):
        if sign.start() < closed:
            continue  # inside a quoted value
        low = max(0, sign.start() - NAMED)
        before = text[low : sign.start()].lower()
        # Most signs have no such name before them, which plain searches tell soonest.
        name = _NAMED.search(before) if any(part in before for part in _PARTS) else None
        if name is None:
            continue
        at = sign.end()
        scheme = _SCHEME.match(text, at)
        at = scheme.end() if scheme else at
        value = _QUOTED.match(text, at)
        if value is not None:
            start, end = value.span(2)
            closed = end
        else:
            # The end of a run without blanks is looked for once, for all values in it.
            value = None if at < run else _BARE.match(text, at)
            if value is None and at >= run:
                continue
            start, end = (at, run) if value is None else value.span()
            run = end
        begin = low + min(name.start(), sign.start() - low)
        if found and found[-1][2] > begin:
            # A bare value that holds another assignment ends where that begins.
            found[-1] = (*found[-1][:2], max(found[-1][1], begin))
        found.append((begin, start, end))
    return found


def _logins(text: str) -> list[tuple[int, int]]:
    """Passwords of addresses, from the colon behind the user to the last at sign."""
    found = []
    for login in _LOGIN.finditer(text):
        stop = _LOGIN_END.search(text, login.end())
        at = text.rfind("@", login.end(), stop.start() if stop else len(text))
        if at > login.end():
            found.append((login.end(), at))
    return found


def _without(start: int, end: int, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What is left of a stretch without those taken, which are in order."""
    left = []
    for i in range(bisect.bisect_right(taken, start, key=lambda x: x[1]), len(taken)):
        s, e = taken[i]
        if s >= end:
            break
        left.append((start, s))
        start = e
    return [(s, e) for s, e in [*left, (start, end)] if s < e]


def spans(text: str) -> list[tuple[int, int]]:
    """Places of candidates, in order and apart.

    Passwords of addresses and values assigned to a credential name count at
    every length. Elsewhere runs of letters alone need 20 of them and others 16,
    and border marks are not part of one.
    """
    logins = _logins(text) if "://" in text else []
    found = list(logins)
    taken = list(logins)
    for begin, start, end in _assigned(text):
        for s, e in _without(start, end, logins):
            value = text[s:e]
            if text[s - 1 : s] not in ("'", '"', "`") or text[e : e + 1] != text[s - 1]:
                # Not quoted: marks of the sentence or structure around are no part of it.
                s += len(value) - len(value.lstrip("([{<\"'`"))
                e -= len(value) - len(value.rstrip(",;.)]}>\"'`"))
            if s < e and not text[s:e].isspace():
                found.append((s, e))
        taken += _without(begin, max(start, end), logins)
    taken.sort()
    for low, high in _without(0, len(text), taken) if taken else [(0, len(text))]:
        for match in _CANDIDATE.finditer(text, low, high):
            value = match[0]
            start = match.start() + len(value) - len(value.lstrip("=.-~"))
            value = value.strip("=.-~") if not value.rstrip(".-~").endswith("=") else value.lstrip("=.-~").rstrip(".-~")
            if len(value) >= (20 if value.isalpha() else 16):
                found.append((start, start + len(value)))
    return sorted(found)


@dataclass
class Words:
    """What the corpus' own words are like: likely transitions between letters, and a dictionary."""

    transitions: dict[str, float]
    words: list[str]

    @classmethod
    def of_counts(cls, pairs: dict[str, int], words: list[str]) -> Words:
        firsts: Counter = Counter()
        for pair, n in pairs.items():
            firsts[pair[0]] += n
        table = {p: math.log((n + 0.5) / (firsts[p[0]] + 20)) for p, n in pairs.items()}
        return cls(table, sorted(w for w in words if len(w) >= 3 and w.isascii()))

    def __getstate__(self):
        return self.transitions, self.words

    def __setstate__(self, state):
        self.transitions, self.words = state

    @property
    def automaton(self):
        if "_automaton" not in self.__dict__:
            self._automaton = ahocorasick.Automaton()
            for word in self.words:
                self._automaton.add_word(word, len(word))
            self._automaton.make_automaton()
        return self._automaton

    def coverage(self, value: str) -> float:
        """Share of the characters that lie in dictionary words."""
        if not self.words:
            return 0.0
        covered = bytearray(len(value))
        for end, n in self.automaton.iter(value):
            covered[end - n + 1 : end + 1] = b"\x01" * n
        return sum(covered) / len(value)

    def transition(self, value: str) -> float:
        """Mean log probability of neighbouring letters; what no word has is as rare as it gets."""
        pairs = [self.transitions.get(value[i : i + 2], -8.0) for i in range(len(value) - 1)]
        return sum(pairs) / max(1, len(pairs))


def features_of(text: str, start: int, end: int, words: Words) -> list[float]:
    """``FEATURES`` of one candidate in its text."""
    value = text[start:end]
    before, after = text[max(0, start - NEAR) : start], text[end : end + NEAR]
    n = len(value)
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "o" for c in value]
    lower = value.lower()
    shares = [c / n for c in Counter(value).values()]
    last = re.split(r"\s", before)[-1] if before else ""
    name = before.rstrip()
    return [
        float(n),
        kinds.count("d") / n,
        kinds.count("u") / n,
        float(len(set(kinds))),
        sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / n,
        -sum(p * math.log2(p) for p in shares),
        words.transition(lower),
        words.coverage(lower),
        # Base64 has a slash in 64 characters; paths have more.
        float(value.count("/") >= max(2, n / 16) or last.endswith(("/", "\\", "~"))),
        float("@" in last or "://" in last + value or after.startswith("@") or re.search(r"[a-z]\.[a-z]{2,}", value) is not None),
        float(_CREDENTIAL.search(before) is not None),
        float(_HARMLESS.search(before) is not None),
        float(_ASSIGNED.search(name if name.endswith(("=", ":")) else before) is not None),
        float(before.endswith(('"', "'", "`"))),
        sum(not c.isalnum() for c in value) / n,
        float(after.startswith("@") and _LOGIN.fullmatch(before[before.rfind("://") :]) is not None),
    ]


@dataclass
class Forest:
    """A random forest for two classes; each tree as arrays of feature (-1 at a leaf), border, lower child and share."""

    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> Forest:
        """Bootstrap rows of each class in equal numbers, a random third of the features at each node, Gini splits."""
        rng = np.random.default_rng(seed)
        classes = [np.flatnonzero(y == c) for c in (0, 1)]
        if not all(map(len, classes)):
            share = np.array([float(y.mean()) if len(y) else 0.0])
            return cls([(np.array([-1]), np.zeros(1), np.zeros(1, int), share)])
        size = max(map(len, classes))
        tried = max(1, math.ceil(x.shape[1] / 3))
        made = []
        for _ in range(trees):
            rows = np.concatenate([rng.choice(c, size) for c in classes])
            feature, border, child, share = [-1], [0.0], [0], [0.0]
            todo = [(0, rows, 0)]
            while todo:
                node, ids, level = todo.pop()
                share[node] = float(y[ids].mean())
                cut = None
                if level < depth and 0 < share[node] < 1:
                    cut = _best_cut(x, y, ids, rng.choice(x.shape[1], tried, replace=False))
                if cut is None:
                    continue
                feature[node], border[node] = cut
                below = x[ids, cut[0]] < cut[1]
                child[node] = len(feature)
                for part in (ids[below], ids[~below]):
                    todo.append((len(feature), part, level + 1))
                    feature.append(-1), border.append(0.0), child.append(0), share.append(0.0)
            made.append(tuple(map(np.array, (feature, border, child, share))))
        return cls(made)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for feature, border, child, share in self.trees:
            at = np.zeros(len(x), int)
            while (inner := feature[at] >= 0).any():
                who = np.flatnonzero(inner)
                node = at[who]
                at[who] = child[node] + (x[who, feature[node]] >= border[node])
            total += share[at]
        return total / len(self.trees)


def _best_cut(x: np.ndarray, y: np.ndarray, ids: np.ndarray, tried: np.ndarray) -> tuple[int, float] | None:
    best, cut = 1e-12, None
    n, ones = len(ids), y[ids].sum()
    whole = ones * (n - ones) / n
    for f in tried:
        order = np.argsort(x[ids, f], kind="stable")
        values = x[ids[order], f]
        steps = np.flatnonzero(np.diff(values) > 0)
        if not len(steps):
            continue
        below = np.cumsum(y[ids[order]])[steps]
        left = steps + 1
        right, above = n - left, ones - below
        gain = whole - below * (left - below) / left - above * (right - above) / right
        i = int(gain.argmax())
        if gain[i] > best:
            best, cut = float(gain[i]), (int(f), float(values[steps[i]] + values[steps[i] + 1]) / 2)
    return cut


@dataclass
class Model:
    words: Words
    forest: Forest

    def findings(self, text: str) -> list[tuple[int, int, float]]:
        """Start, end and score of each candidate of a text."""
        found = spans(text)
        if not found:
            return []
        rows = np.array([features_of(text, s, e, self.words) for s, e in found])
        return [(s, e, p) for (s, e), p in zip(found, self.forest.score(rows).tolist(), strict=True)]


def made_up_findings(words: list[str], n: int = 3_000, seed: int = SEED) -> list[tuple[str, int, int, int]]:
    """Text, start, end and label of findings as credential scanners meet them, from a seeded generator."""
    rng = random.Random(seed)
    # Words of the corpus, and as many that it does not know.
    known = words or ["word", "other", "thing"]
    words = known + ["".join(rng.choices("etaoinshrdlucmfwypvbgk", k=rng.randrange(3, 9))) for _ in known]
    names = ["token", "secret", "password", "pwd", "passwd", "api_key", "access_key", "auth token", "client_secret"]

    def natural(k: int) -> str:
        return " ".join(rng.choices(words, k=k))

    def secret() -> str:
        data = rng.randbytes(rng.randrange(15, 40))
        return rng.choice(
            [
                data.hex(),
                base64.b64encode(data).decode().rstrip("="),
                base64.urlsafe_b64encode(data).decode().rstrip("="),
                "".join(rng.choices(string.ascii_letters + string.digits, k=rng.randrange(20, 44))),
                "AKIA" + "".join(rng.choices(string.ascii_uppercase + string.digits, k=16)),
            ]
        )

    def short() -> str:
        word = rng.choice(words)
        marks = "!@#$%:&*?_-+"
        return rng.choice(
            [
                "".join(rng.choices(string.ascii_letters + string.digits, k=rng.randrange(4, 15))) + str(rng.randrange(10)),
                "".join(rng.choices(string.ascii_letters + string.digits + marks, k=rng.randrange(6, 18))) + rng.choice(marks),
                word.capitalize().translate(str.maketrans("aeio", "4310")) + str(rng.randrange(10000)) + rng.choice(["", "!", "x", "dor"]),
                word + str(rng.randrange(1000)) + rng.choice(["", *string.ascii_lowercase]),
                word.capitalize() + rng.choice(marks) + rng.choice(words) + str(rng.randrange(100)) + rng.choice(["", *marks]),
                "".join(rng.choices(string.ascii_lowercase, k=16)),
                " ".join("".join(rng.choices(string.ascii_lowercase, k=4)) for _ in range(4)),
            ]
        )

    def placeholder() -> tuple[str, str]:
        name = rng.choice(names)
        before = rng.choice([f"{name}: ", f"{name} = ", f"{name}=", f'"{name}": '])
        other = rng.choice(words)
        return rng.choice(
            [
                (before, other),
                (before, other),
                (before + '"', natural(rng.randrange(2, 6))),
                (before, rng.choice(["none", "None", "null", "true", "false", "required", "string", "str", "optional", "yes", "no"])),
                (before, rng.choice([f"<{other}>", f"${{{other.upper()}}}", f"{{{{ {other} }}}}", f"os.environ[{other.upper()}]"])),
                (before, rng.choice(["*", "x", "."]) * rng.randrange(3, 12)),
                (before, f"{rng.choice(['self', 'config', 'args'])}.{other}"),
                (rng.choice(["max_tokens = ", "tokens: ", "token_count="]), str(rng.randrange(100_000))),
            ]
        )

    def harmless() -> tuple[str, str]:
        joined = rng.choice(["_", "-", "", "."]).join(rng.choices(words, k=rng.randrange(4, 9)))
        camel = "".join(w.capitalize() for w in rng.choices(words, k=rng.randrange(4, 8)))
        digest = hashlib.sha1(rng.randbytes(8)).hexdigest()
        return rng.choice(
            [
                ("", joined),
                ("", camel),
                ("", "/".join(rng.choices(words, k=rng.randrange(4, 8)))),
                ("https://", rng.choice(words) + ".example.com/" + "/".join(rng.choices(words, k=3))),
                (rng.choice(words) + "@", ".".join([*rng.choices(words, k=2), "example.com"])),
                (f"{rng.randrange(100)}@", f"{rng.choice(words)}{rng.randrange(100)}.example." + ".".join(rng.choices(words, k=2))),
                ("http://", f"{rng.choice(words)}{rng.randrange(10)}.example.org/{rng.choice(words)}/{rng.randrange(10000)}"),
                ("", "".join(rng.choices(string.digits, k=rng.randrange(16, 22)))),
                ("commit ", digest),
                ("sha1: ", digest),
                ("checksum ", digest),
                (rng.choice(names) + ' = "', joined),
                (rng.choice(names) + " = ", "x" * rng.randrange(16, 30)),
                ("", rng.choice("=-_.") * 3 + rng.choice(words) * 4),
            ]
        )

    rows = []
    for i in range(n):
        label = i % 2
        behind = ""
        # As many short ones, which only their context makes candidates, as others.
        if i % 4 >= 2:
            if label and rng.random() < 0.3:
                before = f"{rng.choice(['https', 'postgres', 'redis', 'ftp'])}://{rng.choice([*words, ''])}:"
                value, behind = rng.choice([short, secret])().replace(" ", ""), f"@{rng.choice(words)}.example.com/{rng.choice(words)}"
            elif label:
                name = rng.choice(names)
                before = rng.choice([f'{name} = "', f"{name}: ", f"{name}=", f'"{name}": "', f"{name}: '"])
                value = short()
            else:
                before, value = placeholder()
        elif label:
            before = rng.choice([f'{rng.choice(names)} = "', f"{rng.choice(names)}: ", f"{rng.choice(names)}=", "Bearer ", "", '"'])
            value = secret()
        else:
            before, value = harmless()
        before = natural(4) + " " + before
        close = behind or (before[-1] if before[-1] in "\"'" else rng.choice([" ", ", ", "\n"]))
        text = before + value + close + " " + natural(3)
        rows += [(text, s, e, label) for s, e in spans(text) if s <= len(before) < e or before.endswith(text[s:e][:1])][:1]
    return rows


def _weak_label(row: list[float]) -> int | None:
    """1 for a value with digits that is assigned to a credential name; 0 for plain words, numbers and addresses."""
    f = dict(zip(FEATURES, row, strict=True))
    if f["login"]:
        return 1 if 0 < f["digits"] < 1 and not f["path"] else None
    if f["assigned"] and f["credential"] and 0 < f["digits"] < 1 and f["dictionary"] < 0.6:
        return 1
    if f["digits"] in (0.0, 1.0) and not f["credential"] or f["address"] or f["path"]:
        return 0
    return None


def fit_words(df: DataFrame, text: str = "text") -> Words:
    """Words and letter pairs of all documents.

    All words are counted, each once per occurrence. The dictionary are those of
    at most 64 letters that occur ``LEAST`` times and make up one in ``ONE_IN``
    of all words at least, so it has no more than ``ONE_IN`` entries. The pairs
    are those of letters below U+0600, which bounds their table.
    """
    word = F.explode(F.split(F.lower(F.col(f"`{text}`")), r"[^\p{L}]+")).alias("word")
    counts = stored(
        df.where(F.col(f"`{text}`").isNotNull()).select(word).where("length(word) >= 2").groupBy("word").agg(F.count("*").alias("n")),
        "words",
    )
    total = counts.agg(F.sum("n")).first()[0] or 0
    least = max(LEAST, math.ceil(total / ONE_IN))
    known = counts.where((F.col("n") >= least) & (F.length("word") <= 64)).select("word").collect()
    # Pairs overlap; the word's count stands for all its occurrences.
    pair = F.explode(F.regexp_extract_all("word", F.lit(r"(?=([\x{0}-\x{5ff}]{2}))"), F.lit(1))).alias("pair")
    pairs = counts.select(pair, "n").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    return Words.of_counts({r["pair"]: r["n"] for r in pairs}, [r["word"] for r in known])


def _sampled(df: DataFrame, doc_id: str, text: str, where: Column | None = None) -> DataFrame:
    """Documents with the smallest hashes, about ``SAMPLE_DOCUMENTS`` of them."""
    rows = df.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text")).where("text IS NOT NULL")
    if where is not None:
        rows = rows.where(where)
    h = F.xxhash64(F.lit(SEED), "id", "text")
    # Hashes alone are sorted; texts that share the last one come along.
    most = rows.select(h.alias("h")).distinct().orderBy("h").limit(SAMPLE_DOCUMENTS).agg(F.max("h")).first()[0]
    return rows.where(h <= F.lit(most)).select("text") if most is not None else rows.limit(0).select("text")


def weak_findings(df: DataFrame, words: Words, doc_id: str = "doc_id", text: str = "text") -> list[tuple[list[float], int]]:
    """Features and labels of findings that plain rules label; at most ``SAMPLE`` of each label."""

    @arrow_udf(ArrayType(ArrayType(DoubleType())))
    def rows(column: pa.Array) -> pa.Array:
        found = [[features_of(t, s, e, words) for s, e in spans(t)] for t in texts(column)]
        labelled = [[[*r, float(k)] for r in of if (k := _weak_label(r)) is not None] for of in found]
        return pa.array(labelled, pa.list_(pa.list_(pa.float64())))

    holding = _sampled(df, doc_id, text, F.col("text").rlike(_ASSIGNMENT))
    found = holding.union(_sampled(df, doc_id, text)).select(F.explode(rows("text")).alias("r"))
    label = F.element_at("r", -1)
    out = []
    for value in (0.0, 1.0):
        one = found.where(label == value).distinct().orderBy(F.xxhash64(F.lit(SEED), "r"), "r").limit(SAMPLE).collect()
        out += [(list(r["r"][:-1]), int(value)) for r in one]
    return out


def fit(
    df: DataFrame, findings: list[tuple[list[float], int]] | None = None, doc_id: str = "doc_id", text: str = "text"
) -> Model:
    """A forest from labelled findings and the words of the corpus; jobs run while this is called.

    ``findings`` are rows of ``FEATURES`` and their labels (1 secret, 0 not). By
    default they come from ``weak_findings`` and ``made_up_findings``, so an
    empty table gives a model too.
    """
    words = fit_words(df, text)
    if findings is None:
        some = words.words[:: max(1, math.ceil(len(words.words) / MADE_OF))]
        findings = weak_findings(df, words, doc_id, text)
        findings += [(features_of(t, s, e, words), k) for t, s, e, k in made_up_findings(some)]
    x = np.array([f for f, _ in findings], float).reshape(-1, len(FEATURES))
    return Model(words, Forest.fit(x, np.array([k for _, k in findings], float)))


_FINDING = StructType(
    [
        StructField("start", LongType()),
        StructField("length", LongType()),
        StructField("value", StringType()),
        StructField("score", DoubleType()),
        StructField("is_secret", BooleanType()),
    ]
)
_FINDING_ARROW = pa.list_(
    pa.struct(
        [("start", pa.int64()), ("length", pa.int64()), ("value", pa.string()), ("score", pa.float64()), ("is_secret", pa.bool_())]
    )
)


def scan(text: Column, model: Model, spark: SparkSession) -> Column:
    """An array of the candidates of each whole text, in its order; NULL and empty texts have none.

    ``start`` and ``length`` count characters, ``score`` is the forest's, and
    ``is_secret`` holds from ``THRESHOLD`` on; the others are false positives.
    """
    shared = spark.sparkContext.broadcast(model)

    @arrow_udf(ArrayType(_FINDING))
    def scanned(column: pa.Array) -> pa.Array:
        found = [
            [
                {"start": s, "length": e - s, "value": t[s:e], "score": p, "is_secret": p >= THRESHOLD}
                for s, e, p in shared.value.findings(t)
            ]
            for t in texts(column)
        ]
        return pa.array(found, _FINDING_ARROW)

    return scanned(text)


def redact(text: Column, model: Model, spark: SparkSession, mask: str = MASK) -> Column:
    """The text with every secret replaced by the mask; NULL stays NULL."""
    shared = spark.sparkContext.broadcast(model)

    def clean(value: str | None) -> str | None:
        if not value:
            return value
        parts, at = [], 0
        for start, end, score in shared.value.findings(value):
            if score >= THRESHOLD:
                parts += [value[at:start], mask]
                at = end
        return "".join([*parts, value[at:]]) if parts else value

    @arrow_udf(StringType())
    def redacted(column: pa.Array) -> pa.Array:
        return pa.array([clean(v.as_py()) for v in column], pa.string())

    return redacted(text)
