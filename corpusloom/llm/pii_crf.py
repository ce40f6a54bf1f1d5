"""Personal data: fixed base patterns, and a semi-Markov conditional random field that adds spans.

The field scores whole segments of one to ``MAX_TOKENS`` tokens under one of the kinds (or a single
token as ordinary text) by features of the whole span: shape, digits, separators, checksum, octets,
border characters and the words before it.  It is trained by gradient ascent on the log likelihood of
generated sentences (``examples``).  A text is cut into regions around tokens that hold a digit, an
at sign or a spelled-out one, long regions in windows that overlap; within a region a forward-backward pass over segments gives each
segment its posterior, and a Viterbi pass with segments of bounded length chooses borders and kinds
together.  Spans whose posterior is under ``LEAST`` or that touch a base span are not added.

Offsets are code points, the end exclusive.  Null text counts as empty and has no spans.  Rows are
judged one by one, so repeated rows stay and an empty table gives an empty one; of kinds that start at
one place the first of ``KINDS`` is listed first, and of equally good segmentations the field takes the
first found.  A very long text costs memory for itself and one window.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = ("", "email", "ip", "card", "phone", "iban", "ssn", "secret")  # "" is ordinary text
ORDER = {k: i for i, k in enumerate(KINDS)}
MAX_TOKENS = 9
MAX_REGION = 400  # tokens that are judged at once; longer regions are judged in windows
MARGIN = 2 * MAX_TOKENS + 2  # tokens at the border of a window that are left to its neighbour
MAX_TOKEN = 160  # characters; longer tokens are split where they can be
LEAST = 0.95
BUCKETS = 1 << 14

# The base patterns of the contract.
_domain = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+").match
_ip = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)").finditer
_card = re.compile(r"[0-9](?:[\x20-]?[0-9])+").finditer
_phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]").finditer
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"

_has_digit = re.compile(r"[0-9]").search
_not_digit = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of the e-mail pattern, found from the at signs so that the time is linear."""
    low, at = 0, text.find("@")
    while at >= 0:
        local = text[low:at]
        start = low + len(local.rstrip(_LOCAL))
        got = _domain(text, at + 1) if start < at else None
        low = at + 1
        if got:
            yield start, got.end()
            low = got.end()
        at = text.find("@", low)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(a, b, "email") for a, b in emails(text)]
    if _has_digit(text):
        if "." in text:
            found += [(m.start(), m.end(), "ip") for m in _ip(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
        for m in _card(text):
            if 12 <= m.end() - m.start() and 12 <= len(d := _not_digit.sub("", m[0])) <= 19 and luhn(d):
                found.append((m.start(), m.end(), "card"))
        if "+" in text:
            found += [(m.start(), m.end(), "phone") for m in _phone(text) if 9 <= len(_not_digit.sub("", m[0])) <= 15]
    return sorted(found, key=lambda s: (s[0], ORDER[s[2]], s[1]))


_token = re.compile(r"[^\s]+")
_spelled = re.compile(r"[\[({<]?(?:at|AT|dot|DOT)[\])}>]?$")


_letters = re.compile(r"[^\W\d_]+")
_part_of_name = re.compile(r"[a-z]+").findall
_LINKS = ("is", "was", "ist", "est", "es")
_head = re.compile(r"([A-Za-z]+)[_-]").findall
_code = re.compile(r"(?=.*[0-9])[A-Za-z0-9_+/-]+$").match
_hex = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)$").match
_digits = re.compile(r"[0-9]+")


def code(s: str) -> str:
    """Alphabet and length of a run of letters and digits, as keys and tokens have them."""
    if not 16 <= len(s) <= 128 or not _code(s):
        return "no"
    kind = "hex" if _hex(s) else "both" if s.lower() != s != s.upper() else "one"
    return f"{kind}{min(len(s) // 16, 3)}"


def shape(s: str) -> str:
    return _digits.sub("9+", _letters.sub("a+", s))


def core(token: str) -> tuple[int, int]:
    """Borders of a token without the punctuation around it."""
    a, b = 0, len(token)
    while a < b and not (token[a].isalnum() or token[a] in "+("):
        a += 1
    while b > a and not (token[b - 1].isalnum()):
        b -= 1
    return a, b


def cues(before: str, before2: str) -> list[str]:
    """Parts of the words that may name what follows, whole and by their first four letters: those of the
    word before or, if that one is no more than a sign or a linking word, of the one before it."""
    parts = _part_of_name(before2 if before in _LINKS or not _part_of_name(before) else before)
    return [f for p in parts for f in (f"cue={p}", f"cue4={p[:4]}")]


def span_features(body: str, before: str, before2: str, tokens: int) -> list[str]:
    """Features of a whole candidate segment and of the two words before it."""
    digits = _not_digit.sub("", body)
    form = shape(body)
    octets = body.split(".")
    out = [
        f"shape={form[:40]}",
        f"tokens={tokens}",
        f"digits={len(digits)}",
        f"before={before}",
        f"two={before2}",
        f"at={'@' in body or bool(re.search(r'(?i)[ \[({<]at[ \])}>]', body))}",
        f"dot={bool(re.search(r'(?i)[ \[({<]dot[ \])}>]', body))}",
        f"letters={bool(_letters.search(body))}",
        f"octets={len(octets) == 4 and all(o.isdigit() and len(o) <= 3 and int(o) <= 255 for o in octets)}",
        f"luhn={12 <= len(digits) <= 19 and luhn(digits)}",
        f"plus={body[:1] == '+' or body[:2] == '00'}",
        f"seps={''.join(sorted(set(_plain.sub('', body))))[:8]}",
        f"groups={'-'.join(str(len(g)) for g in re.findall('[0-9]+', body))[:30]}",
    ]
    plain = sum(not _has_digit(w) and not _spelled.match(w.strip(",.;:")) for w in body.split())
    out.append(f"plain={min(plain, 5)}+{out[5]}+{out[6]}")
    secret = code(body)
    if secret != "no" and len(_letters.findall(body)) > 4:  # no two of them look alike, so shape and groups of digits tell nothing
        heads = [f"head={h.lower()}" for h in _head(body[:16])]
        return [f"tokens={tokens}", f"code={secret}", *cues(before, before2), *heads]
    return out + [f"before+digits={before}+{len(digits)}", f"letters+digits={out[7]}+{len(digits)}"]


_plain = re.compile(r"[0-9A-Za-z]")


def _rows(features: list[str]) -> np.ndarray:
    import zlib

    return np.array([zlib.crc32(f.encode()) % BUCKETS for f in features])


_ORDINARY = np.array([0.0] + [-math.inf] * (len(KINDS) - 1))


class Field:
    """Weights of the field: one row per hashed feature, one column per kind."""

    def __init__(self):
        self.w = np.zeros((BUCKETS, len(KINDS)))
        self._plain = np.zeros(0, np.int64)  # a token without a mark is ordinary text

    def segments(self, text: str, spans: list[tuple[int, int]]) -> dict[tuple[int, int], np.ndarray]:
        """Feature rows of all segments [i, j) of tokens given by their borders."""
        words = [text[a:b] for a, b in spans]
        clean = [w.strip(".,;:!?()[]\"'").lower().rstrip("=:") or w for w in words]
        spelled = [bool(_spelled.match(w.strip(",.;:"))) for w in words] + [False]
        marked = [spelled[k] or "@" in w or bool(_has_digit(w)) for k, w in enumerate(words)]
        opens = [marked[k] or spelled[k + 1] for k in range(len(words))]
        closes = [marked[k] or (k > 0 and spelled[k - 1]) for k in range(len(words))]
        out = {}
        for i in range(len(spans)):
            out[i, i + 1] = self._plain
            for j in range(i + 1, min(len(spans), i + MAX_TOKENS) + 1):
                if not opens[i] or (j > i + 1 and spans[j - 1][0] - spans[j - 2][1] > 1):
                    break
                if not closes[j - 1] or not any(marked[i:j]):
                    continue
                a, b = spans[i][0] + core(words[i])[0], spans[j - 1][0] + core(words[j - 1])[1]
                out[i, j] = _rows(span_features(text[a:b], clean[i - 1] if i else "^", clean[i - 2] if i > 1 else "^", j - i))
        return out

    def scores(self, segments: dict, dtype=float) -> dict[tuple[int, int], np.ndarray]:
        got = {}
        for (i, j), rows in segments.items():
            if not len(rows):
                got[i, j] = _ORDINARY
                continue
            s = self.w[rows].sum(axis=0)
            if j - i > 1:
                s[0] = -math.inf  # ordinary text is one token long
            got[i, j] = s
        return got

    @staticmethod
    def forward_backward(n: int, scores: dict) -> tuple[float, dict[tuple[int, int], np.ndarray]]:
        """Log partition and the posterior of every segment and kind."""
        ending: list[list] = [[] for _ in range(n + 1)]
        starting: list[list] = [[] for _ in range(n + 1)]
        total = {k: float(np.logaddexp.reduce(s)) for k, s in scores.items()}
        for i, j in scores:
            ending[j].append(i)
            starting[i].append(j)
        alpha, beta = [0.0] + [-math.inf] * n, [-math.inf] * n + [0.0]
        for j in range(1, n + 1):
            alpha[j] = float(np.logaddexp.reduce([alpha[i] + total[i, j] for i in ending[j]]))
        for i in range(n - 1, -1, -1):
            beta[i] = float(np.logaddexp.reduce([beta[j] + total[i, j] for j in starting[i]]))
        z = alpha[n]
        return z, {(i, j): np.exp(s + alpha[i] + beta[j] - z) for (i, j), s in scores.items()}

    @staticmethod
    def viterbi(n: int, scores: dict) -> list[tuple[int, int, int]]:
        best, back = [0.0] + [-math.inf] * n, [None] * (n + 1)
        for (i, j), s in sorted(scores.items(), key=lambda kv: kv[0][1]):
            k = int(s.argmax())
            if best[i] + s[k] > best[j]:
                best[j], back[j] = best[i] + s[k], (i, j, k)
        out, at = [], n
        while at:
            out.append(back[at])
            at = back[at][0]
        return out[::-1]

    def fit(self, data: list, epochs: int = 3, rate: float = 0.25, shrink: float = 1e-4) -> Field:
        prepared = [(len(spans), self.segments(text, spans), gold) for text, spans, gold in data]
        for epoch in range(epochs):
            eta = rate / (1 + epoch)
            for n, segments, gold in prepared:
                _, posterior = self.forward_backward(n, self.scores(segments))
                for key, rows in segments.items():
                    step = -posterior[key]
                    if key in gold:
                        step = step.copy()
                        step[gold[key]] += 1
                    if len(rows) and np.abs(step).max() > 1e-3:
                        np.add.at(self.w, rows, eta * step)
            self.w *= 1 - shrink
        return self

    def spans(self, text: str, taken: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
        """Spans that the field adds to the base ones."""
        found = []
        for region, low, high in windows(regions(text, taken)):
            segments = self.segments(text, region)
            scores = self.scores(segments)
            chosen = [c for c in self.viterbi(len(region), scores) if c[2]]
            if not chosen:
                continue
            _, posterior = self.forward_backward(len(region), scores)
            for i, j, k in chosen:
                if not low <= i < high:
                    continue
                a = region[i][0] + core(text[slice(*region[i])])[0]
                b = region[j - 1][0] + core(text[slice(*region[j - 1])])[1]
                if a < b and posterior[i, j][k] >= LEAST and not any(s < b and a < e for s, e, _ in taken) and (not found or found[-1][1] <= a):
                    found.append((a, b, KINDS[k]))
        return found


_region_mark = re.compile(r"[0-9@]|(?<=[\s\[({<])(?:at|AT|dot|DOT)(?=[\s\])}>])").finditer


def regions(text: str, taken: list[tuple[int, int, str]] = ()) -> Iterator[list[tuple[int, int]]]:
    """Token borders around marks outside ``taken`` (sorted by start), some tokens to either side."""
    joined: list[list[int]] = []
    at, covered = 0, 0
    for m in _region_mark(text):
        while at < len(taken) and taken[at][0] <= m.start():
            covered = max(covered, taken[at][1])
            at += 1
        if m.start() < covered:
            continue
        a, b = max(0, m.start() - 48), m.end() + 48
        if joined and a <= joined[-1][1]:
            joined[-1][1] = b
        else:
            joined.append([a, b])
    for a, b in joined:
        while a > 0 and not text[a - 1].isspace():
            a -= 1
            if text[a : a + 1].isspace():
                break
        spans = [(m.start(), m.end()) for m in _token.finditer(text, a, min(len(text), b))]
        if spans and spans[-1][1] == b:
            spans[-1] = (spans[-1][0], (_token.match(text, spans[-1][0])).end())
        yield [piece for s in spans for piece in pieces(text, *s)]


_assigned = re.compile(r"[\"'{(]?[A-Za-z][\w-]*[\"']?(?::?=|:)(?!//)").match


_part = re.compile(r"[^,;|&=?/<>{}\"']*[,;|&=?/<>{}\"']|[^,;|&=?/<>{}\"']+").finditer
_run = re.compile(r"[\W_]*[^\W_]+").finditer


def pieces(text: str, a: int, b: int) -> list[tuple[int, int]]:
    """Borders of a token or, if it gives a name a long value or is long itself, of its parts: the name and
    the value; cut after separators and, where that is not
    enough, between letters and digits and whatever else.  A run of more than ``MAX_TOKEN`` letters
    and digits alone has no border within and goes."""
    name = _assigned(text, a, b)
    if name and b - name.end() >= 16:
        return [(a, name.end()), *pieces(text, name.end(), b)]
    if b - a <= MAX_TOKEN:
        return [(a, b)]
    parts = [(m.start(), m.end()) for m in _part(text, a, b)]
    fine = [s for p in parts for s in ([p] if p[1] - p[0] <= MAX_TOKEN else [(m.start(), m.end()) for m in _run(text, *p)])]
    return fine


def windows(found: Iterator[list[tuple[int, int]]]) -> Iterator[tuple[list[tuple[int, int]], int, int]]:
    """Tokens of each region, in overlapping windows if it is long, with the first token and the one
    after the last at which a span of the window counts: each token of a region counts once."""
    for region in found:
        at = 0
        while True:
            last = at + MAX_REGION >= len(region)
            yield region[at : at + MAX_REGION], MARGIN if at else 0, MAX_REGION if last else MAX_REGION - MARGIN
            if last:
                break
            at += MAX_REGION - 2 * MARGIN


def examples(count: int = 3200, seed: int = 5) -> list[tuple[str, list[tuple[int, int]], dict[tuple[int, int], int]]]:
    """Generated sentences with gold segments, in the forms that the base patterns miss, and with
    numbers that are no personal data."""
    rng = random.Random(seed)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = lambda: "".join(rng.choice("abcdefghiklmnoprstuvz") for _ in range(rng.randint(2, 9)))

    def card() -> str:
        body = rng.choice("3456") + digits(14)
        number = next(body + c for c in "0123456789" if luhn(body + c))
        sep = rng.choice([".", "/", "  ", "_"])
        return sep.join(number[k : k + 4] for k in range(0, 16, 4))

    def email() -> str:
        at, dot = rng.choice([(" at ", " dot "), (" [at] ", " [dot] "), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" AT ", " DOT ")])
        host = dot.join([word(), rng.choice(["com", "org", "net", "de", "fr", "es"])])
        return rng.choice([word(), f"{word()}.{word()}", word() + digits(2)]) + at + host

    def phone() -> str:
        return rng.choice([f"({digits(3)}) {digits(3)}-{digits(4)}", f"{digits(3)}-{digits(3)}-{digits(4)}", f"{digits(3)}.{digits(3)}.{digits(4)}", f"0{digits(3)} {digits(7)}", f"0{digits(1)} {digits(2)} {digits(2)} {digits(2)} {digits(2)}", f"00{digits(2)} {digits(3)} {digits(6)}"])

    def ip() -> str:
        return rng.choice([" . ", "[.]"]).join(str(rng.randint(1, 255)) for _ in range(4))

    def iban() -> str:
        body = rng.choice(["DE", "FR", "ES", "GB"]) + digits(20)
        return body if rng.random() < 0.5 else " ".join(body[k : k + 4] for k in range(0, 22, 4))

    def ssn() -> str:
        return f"{digits(3)}-{digits(2)}-{digits(4)}"

    heads = ["sk_live_", "sk_test_", "pk_live_", "ghp_", "gho_", "key_live_", "xoxb-"]

    def secret() -> str:
        letters = rng.choice(["0123456789abcdef", "0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"])
        value = "".join(rng.choice(letters) for _ in range(rng.choice([20, 24, 32, 40, 40, 64, 96, 128])))
        if rng.random() < 0.25:  # values that name themselves
            value = rng.choice(heads) + value[:40]
        return rng.choice(['"{}"', "'{}'", "{}"]).format(value)

    makers = {"email": email, "ip": ip, "card": card, "phone": phone, "iban": iban, "ssn": ssn, "secret": secret}
    cue = {"email": ["email", "mail", "contact"], "ip": ["ip", "address", "host"], "card": ["card", "visa", "pay"], "phone": ["call", "phone", "tel", "tel."], "iban": ["iban", "account"], "ssn": ["ssn", "social"], "secret": []}
    roots = "token secret password passwd pwd passphrase passcode passwort key apikey credential credentials".split()
    owners = "api access auth client private my app service session db user admin root login signing".split()
    others = "commit sha hash checksum digest version revision uuid build file block object passage passenger keyword keyboard tokenizer secretary sum id".split()

    def name() -> str:
        """A name for a secret, of parts, in the writings that programs and people use."""
        parts = [*[rng.choice([rng.choice(owners), word()]) for _ in range(rng.choice([0, 0, 1, 1, 2]))], rng.choice(roots)]
        joined = rng.choice(["_", "_", "-", "."]).join(parts)
        return rng.choice([joined, joined.upper(), joined.title()])
    plain = [
        lambda: digits(rng.randint(1, 9)),
        lambda: digits(16),
        lambda: str(rng.randint(1800, 2030)),
        lambda: f"{rng.randint(1, 28)}.{rng.randint(1, 12)}.{rng.randint(1900, 2030)}",
        lambda: f"{rng.randint(1900, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}",
        lambda: f"{rng.randint(1, 9)}.{rng.randint(0, 99)}",
        lambda: "v" + ".".join(str(rng.randint(0, 9)) for _ in range(rng.randint(2, 4))),
        lambda: f"{rng.randint(1, 999)},{digits(3)}",
        lambda: f"{digits(2)}:{digits(2)}",
        lambda: "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice([8, 16, 32, 40, 64, 96, 128]))),
        lambda: '"' + "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice([20, 32, 40]))) + '"',
        lambda: f"{word()}{digits(2)}@mail{digits(1)}.example.com",
        lambda: f"{digits(1)}-{digits(2)}",
        lambda: " ".join(digits(rng.randint(1, 4)) for _ in range(rng.randint(2, 6))),
        lambda: " | ".join(digits(rng.randint(1, 4)) for _ in range(3)),
        lambda: f"{word()} at {word()} dot",
        lambda: f"at {word()}",
    ]
    out = []
    for _ in range(count):
        parts: list[tuple[str, int]] = [(word(), 0) for _ in range(rng.randint(1, 4))]
        for _ in range(rng.randint(1, 4)):  # spans over several numbers are seen, and seen to be wrong
            if rng.random() < 0.5:
                kind = rng.choice([*makers, "secret", "secret"])
                body = makers[kind]()
                if kind == "secret":  # nothing but what stands before it tells a secret from an identifier
                    way = rng.random()
                    if any(h in body for h in heads) and rng.random() < 0.6:
                        parts.append((word(), 0))
                    elif way < 0.4:
                        parts += [(name(), 0), (rng.choice(["=", "=", ":", ":="]), 0)]
                    elif way < 0.75:
                        parts.append((name() + rng.choice([":", "=", ""]), 0))
                    elif way < 0.9:
                        parts += [(rng.choice(["my", "the", "a", word()]), 0), (rng.choice(roots), 0), (rng.choice(_LINKS), 0)]
                    else:
                        parts.append((rng.choice(["bearer", "Bearer", "basic"]), 0))
                elif rng.random() < 0.6:
                    parts.append((rng.choice(cue[kind]) + rng.choice(["", ":"]), 0))
                parts.append((body, ORDER[kind]))
            else:
                if rng.random() < 0.3:
                    parts.append((rng.choice(cue[rng.choice([k for k in cue if k != "secret"])]), 0))
                elif rng.random() < 0.3:
                    parts += [(rng.choice([word(), rng.choice(others), f"{word()}_{rng.choice(others)}"]), 0), (rng.choice(["=", ":", "is"]), 0)]
                parts.append((rng.choice(plain)(), 0))
            parts += [(word(), 0) for _ in range(rng.randint(0, 3))]
        text, spans, gold = "", [], {}
        for body, kind in parts:
            text += " " if text else ""
            at = len(text)
            text += body + (rng.choice([".", ",", ""]) if rng.random() < 0.2 else "")
            own = [(m.start(), m.end()) for m in _token.finditer(text, at)]
            if kind and len(own) <= MAX_TOKENS:
                gold[len(spans), len(spans) + len(own)] = kind
            else:
                gold |= {(len(spans) + k, len(spans) + k + 1): 0 for k in range(len(own))}
            spans += own
        joined = all(b[0] - a[1] <= 1 for a, b in zip(spans, spans[1:]))  # noqa: RUF007
        if joined:
            out.append((text, spans, gold))
    return out


_field: list[Field] = []


def field() -> Field:
    """The trained field; training is deterministic, so every process gets the same one."""
    if not _field:
        _field.append(Field().fit(examples(), epochs=4, rate=0.5))
    return _field[0]


def listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], ORDER[s[2]], s[1])))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, base counts, digest of the base spans, all spans and their number, for every whole text."""
    weights = field().w.astype(np.float32)
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Field()
        own.w = weights.astype(np.float64)
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for text in batch.column(1).to_pylist():
                base = base_spans(text or "")
                for k, kind in enumerate(BASE_KINDS):
                    out[k].append(sum(s[2] == kind for s in base))
                out[4].append(hashlib.sha256(listed(base).encode()).hexdigest())
                every = base + own.spans(text or "", base)
                out[5].append(listed(every))
                out[6].append(len(every))
            longs = lambda c: pa.array(c, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(longs, out[:4]), *(pa.array(c, pa.string()) for c in out[4:6]), longs(out[6])], names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_spans"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
