"""Secret scan: base patterns and a linear-chain conditional random field.

Three patterns give the base spans. A conditional random field tags tokens as the
begin, inside or outside of a secret and adds spans that the patterns miss. It is
trained on texts in which the patterns fire, and on texts in which they do not: as
they are, with a made-up secret of another form planted in them (other names of keys,
headers, passwords in addresses, prefixed keys, key files, bare keys), and with
planted strings that only look like one (numbers, times, paths, names in code). A token's features are its shape
and form, the tokens around it and figures of its text. Its score for a tag is
the sum of three memoised vectors (its own, its neighbours') and the text's.

Decoding is Viterbi, done only where it can matter: a token whose score beside its
neighbours and in its text is so low for every tag but ``outside`` that no moves could make
up for it is outside in every best path. These scores are sums of rows of a table of words.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusqa.llm.common import byte_values, pieces, stored, widen

# Fixed patterns of the base scan, letters in either case in the first.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "crf")
LEAST = {"assign": 12, "access": 18, "hex": 16}
# A word that holds none of these begins no base span: only texts with such a
# word are searched by the patterns.
_HINT = re.compile(r"passw|secret|token|api_?key|AKIA|(?-i:[0-9a-f]{16})", re.ASCII | re.IGNORECASE).search

O, B, I = 0, 1, 2
TAGS = 3
GROUP = 1 << 12  # buckets of each group of features
OWN, SIDE, FILE = 11, 3, 3  # groups of a token's own features, of each neighbour's, of the text's
BUCKETS = (OWN + 2 * SIDE + FILE) * GROUP
SAMPLE = 600  # texts with base spans in the training sample, and as many without
HASH_SHARE = 16  # the lowest hashes, one in so many, are looked at first for the sample
AROUND = 10  # tokens on either side of a secret, or of a place drawn at random, that train
STEPS = 2_000  # of training, if it does not end before
FLAT = 1e-4  # largest slope where it ends
RIDGE = 1e-5  # on a weight of a token's own features
CONTEXT_RIDGE = 1e-3  # on one of neighbours or text, and on moves: a context seen a few times tells little
MEMO = 300_000
PIECE = 24  # characters of a token, at most
_TOKEN = re.compile(r"[\w+/\-]{1,%d}|[^\w\s]" % PIECE)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns' matches that pass, by start, then kind."""
    out = []
    for m in ASSIGN.finditer(text):
        if len(m[2]) >= LEAST["assign"]:
            out.append((m.start(), m.end(), "assign"))
    for kind, own in (("access", ACCESS), ("hex", HEX)):
        out += [(m.start(), m.end(), kind) for m in own.finditer(text) if m.end() - m.start() >= LEAST[kind]]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def secrets_of(text: str) -> list[tuple[int, int]]:
    """What the base spans hide: an assignment's value, all of the others."""
    out = [m.span(2) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    return out + [(a, b) for a, b, kind in base_spans(text) if kind != "assign"]


# ---- features ---------------------------------------------------------------


def _codes(first: int, values: list) -> list[int]:
    """Buckets of features: each group has its own, so that the most a group can
    add to a score is known."""
    import xxhash

    return [(first + i) * GROUP + xxhash.xxh32_intdigest(str(v)) % GROUP for i, v in enumerate(values)]


def shape(token: str) -> str:
    """Runs of capitals, other letters, numerals and other signs; + for more than one."""
    kinds = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in token[:PIECE])
    return re.sub(r"(.)\1+", r"\1+", kinds)


def own_features(token: str) -> list[int]:
    """Of the token itself: shape, length, mixture of character kinds."""
    changes = sum(a.isdigit() != b.isdigit() for a, b in zip(token, token[1:]))
    hexes = all(c in "0123456789abcdef" for c in token)
    plain = token.isalpha() and token[1:].lower() == token[1:]
    cases = sum(a.islower() and b.isupper() for a, b in zip(token, token[1:]))
    values = ["bias", shape(token)[:8], min(len(token) // 3, 8), min(changes, 6), min(len(set(token)) // 3, 6)]
    values += [token[:4] if len(token) >= 12 and token[:4].isupper() else "", len(token) >= 10 and changes >= 2, hexes and len(token) >= 12, plain]
    values += [min(cases, 6), (min(changes, 3), min(cases, 3), min(len(token) // 6, 4))]
    return _codes(0, values)


def side_features(token: str, right: bool) -> list[int]:
    """Of a neighbour: its letters in lower case with numerals as 0, its shape."""
    low = "".join("0" if c.isdigit() else c for c in token.lower())
    values = [low if len(low) <= 12 else "", shape(token)[:6], len(token) >= 10 and any(map(str.isdigit, token))]
    return _codes(OWN + SIDE * right, values)


def file_features(raw: bytes) -> list[int]:
    """Of the whole text: share of numerals, assignment signs and quotes a line."""
    n, lines = max(len(raw), 1), raw.count(b"\n") + 1
    digits = len(raw) - len(raw.translate(None, b"0123456789"))
    signs, quotes = raw.count(b"=") + raw.count(b":"), raw.count(b'"')
    return _codes(OWN + 2 * SIDE, [min(int(100 * digits / n), 9), min(signs * 4 // lines, 6), min(quotes * 2 // lines, 4)])


# ---- training ---------------------------------------------------------------


@dataclass
class Model:
    weights: object  # BUCKETS x TAGS
    move: object  # TAGS x TAGS, from one tag to the next


def marginals(unary, move, mask):
    """Forward and backward over a padded batch (n x T x TAGS): the probabilities of
    the tags and of the moves, and the logarithm of each sequence's sum over all paths.
    ``mask`` marks the tokens of each sequence."""
    import numpy as np

    def lse(z, axis):
        top = z.max(axis=axis, keepdims=True)
        return (top + np.log(np.exp(z - top).sum(axis=axis, keepdims=True))).squeeze(axis)

    a, b = np.zeros_like(unary), np.zeros_like(unary)
    a[:, 0] = unary[:, 0]
    for t in range(1, unary.shape[1]):
        new = unary[:, t] + lse(a[:, t - 1, :, None] + move, 1)
        a[:, t] = np.where(mask[:, t, None], new, a[:, t - 1])
    for t in range(unary.shape[1] - 2, -1, -1):
        new = lse(move + (unary[:, t + 1] + b[:, t + 1])[:, None], 2)
        b[:, t] = np.where(mask[:, t + 1, None], new, 0)
    z = lse(a[:, -1], 1)
    tags = np.exp(a + b - z[:, None, None]) * mask[..., None]
    pairs = np.exp(np.minimum(a[:, :-1, :, None] + move + (unary[:, 1:] + b[:, 1:])[:, :, None] - z[:, None, None, None], 0))
    return tags, pairs * mask[:, 1:, None, None], z


def lowest(value, x, steps: int, flat: float = FLAT):
    """Where ``value(x)`` (a convex function and its slope) is lowest, by L-BFGS: until no
    slope is over ``flat``, or for ``steps`` steps."""
    import numpy as np

    f, g = value(x)
    past: list = []  # (step, change of slope), the last ten
    for _ in range(steps):
        if abs(g).max() <= flat:
            break
        way, kept = -g, []
        for s, y in reversed(past):
            kept.append((s @ way) / (s @ y))
            way = way - kept[-1] * y
        if past:
            way = way * ((past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1]))
        for (s, y), c in zip(past, reversed(kept)):
            way = way + (c - (y @ way) / (s @ y)) * s
        size, fall = (1.0 if past else min(1.0, 1 / abs(g).sum())), g @ way
        while True:
            new, slope = value(x + size * way)
            if new <= f + 1e-4 * size * fall or size < 1e-9:
                break
            size /= 2
        if size < 1e-9:
            break
        step, change = size * way, slope - g
        if step @ change > 1e-12:
            past = [*past[-9:], (step, change)]
        x, f, g = x + step, new, slope
    return x


def train(rows: list[tuple[list[list[int]], list[int]]], steps: int = STEPS) -> Model:
    """Maximum likelihood with a ridge, over all sequences at once, until it is reached. No weight is
    bounded. A row is a sequence: feature codes of each token, and its tags."""
    import numpy as np

    n, T = len(rows), max(len(r[1]) for r in rows)
    width = OWN + 2 * SIDE + FILE
    codes = np.full((n, T, width), BUCKETS, np.int64)  # no token: a bucket after the last
    gold, mask = np.zeros((n, T), np.int64), np.zeros((n, T), bool)
    for i, (features, tags) in enumerate(rows):
        codes[i, : len(tags)] = features
        gold[i, : len(tags)] = tags
        mask[i, : len(tags)] = True
    used, flat = np.unique(codes, return_inverse=True)
    flat = flat.reshape(codes.shape)
    real = (used < BUCKETS)[:, None]
    ridge = np.concatenate([np.where(used >= OWN * GROUP, CONTEXT_RIDGE, RIDGE).repeat(TAGS), np.full(TAGS * TAGS, CONTEXT_RIDGE)])
    truth = np.eye(TAGS)[gold] * mask[..., None]
    moves = np.einsum("nti,ntj->ij", truth[:, :-1] * mask[:, 1:, None], truth[:, 1:])
    split = lambda x: (x[: -TAGS * TAGS].reshape(-1, TAGS), x[-TAGS * TAGS :].reshape(TAGS, TAGS))

    def loss(x):
        weights, move = split(x)
        unary = (weights * real)[flat].sum(axis=2)
        tags, pairs, z = marginals(unary, move, mask)
        rest = (tags - truth).reshape(-1, TAGS)
        by_token = [np.bincount(flat.ravel(), np.repeat(rest[:, k], width), minlength=len(used)) for k in range(TAGS)]
        slope = np.concatenate([(np.stack(by_token, axis=1) * real).ravel(), (pairs.sum(axis=(0, 1)) - moves).ravel()])
        return (z.sum() - (unary * truth).sum() - (move * moves).sum()) / n + (ridge * x * x).sum() / 2, slope / n + ridge * x

    best, move = split(lowest(loss, np.zeros(len(ridge)), steps))
    weights = np.zeros((BUCKETS, TAGS))
    weights[used[used < BUCKETS]] = best[used < BUCKETS]
    return Model(weights, move)


# Forms of planted secrets and of strings that look like them.
_NAMES = ("pwd", "pass", "auth", "credential", "private_key", "client_key", "access_key", "signing_key", "session_id", "webhook")
_SIGNS = ("=", " = ", ": ", ":", '="', ": '", '": "')
_PREFIXES = ("sk_live_", "pk_test_", "ghp_", "xoxb-", "key-", "pat_")
_LETTERS, _CAPITALS, _NUMERALS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
_MIXED = _LETTERS + _CAPITALS + _NUMERALS


def _random(rng, least: int, most: int) -> str:
    """A random value with a letter and a numeral."""
    signs = rng.choice((_MIXED, _MIXED, _MIXED + "+/", _MIXED + "-_", _CAPITALS + _NUMERALS, _LETTERS + _NUMERALS))
    while True:
        out = "".join(rng.choices(signs, k=rng.randint(least, most)))
        if any(map(str.isdigit, out)) and any(map(str.isalpha, out)):
            return out


def made_up(rng) -> tuple[str, str, str]:
    """A made-up secret: what stands before it, itself, what stands after it."""
    kind = rng.randrange(6)
    if kind == 0:
        sign = rng.choice(_SIGNS)
        return rng.choice(_NAMES) + sign, _random(rng, 12, 40), sign[-1] if sign[-1] in "\"'" else ""
    if kind == 1:
        return "Authorization: " + rng.choice(("Bearer ", "Basic ")), _random(rng, 20, 60), ""
    if kind == 2:
        return f"{rng.choice(('postgres', 'mysql', 'amqp', 'https'))}://{_word(rng)}:", _random(rng, 12, 24), f"@{_word(rng)}.{_word(rng)}"
    if kind == 3:
        return "", rng.choice(_PREFIXES) + _random(rng, 20, 36), ""
    if kind == 4:
        body = "\n".join("".join(rng.choices(_MIXED + "+/", k=64)) for _ in range(rng.randint(1, 3)))
        return "-----BEGIN PRIVATE KEY-----\n", body, "\n-----END PRIVATE KEY-----"
    return "", _random(rng, 20, 40), ""


def _word(rng) -> str:
    return "".join(rng.choices(_LETTERS, k=rng.randint(3, 10)))


def look_alike(rng) -> str:
    """A string that is no secret, though it has signs of one."""
    n = lambda k: "".join(rng.choices(_NUMERALS, k=k))
    kind = rng.randrange(13)
    if kind == 0:
        return n(rng.randint(5, 20))
    if kind == 1:
        return f"20{n(2)}-0{n(1)}-1{n(1)}" + rng.choice(("", f"T1{n(1)}:{n(2)}:{n(2)}Z"))
    if kind == 2:
        return f"v{n(1)}.{n(2)}.{n(1)}-{_word(rng)}{n(1)}"
    if kind == 3:
        return "/" + "/".join(_word(rng) for _ in range(rng.randint(2, 5))) + f"-{n(1)}.{n(1)}"
    if kind == 4:
        return f"https://{_word(rng)}.{_word(rng)}/{_word(rng)}/{_word(rng)}-{n(4)}"
    if kind == 5:
        return f"{_word(rng)}.{_word(rng)}{n(2)}@{_word(rng)}.{_word(rng)}"
    if kind == 6:
        return "".join(_word(rng).title() for _ in range(rng.randint(2, 4))) + rng.choice(("", n(1)))
    if kind == 7:
        return "_".join(_word(rng) for _ in range(rng.randint(2, 4))).upper()
    if kind == 8:
        return "+" + "-".join(n(rng.randint(1, 4)) for _ in range(rng.randint(2, 4)))
    if kind == 9:
        return rng.choice(_NAMES) + rng.choice(_SIGNS[:4]) + _word(rng)
    if kind == 10:
        return "-".join(_word(rng) for _ in range(rng.randint(2, 5)))
    if kind == 11:
        return f"{rng.choice(_CAPITALS)}{rng.choice(_CAPITALS)}-{n(rng.randint(3, 8))}"
    return f"{n(rng.randint(1, 4))}{_word(rng)[:3]}"


def _sequence(tokens: list, tags: list[int], centre: int, file: list[int]) -> tuple[list[list[int]], list[int]]:
    """The tokens around ``centre`` as a training sequence."""
    names = ["", *(t[2] for t in tokens), ""]
    part = range(max(0, centre - AROUND), min(len(tokens), centre + AROUND + 4))
    features = [own_features(names[i + 1]) + side_features(names[i], False) + side_features(names[i + 2], True) + file for i in part]
    return features, [tags[i] for i in part]


def _tagged(text: str, spans: list) -> tuple[list, list[int], list[int]]:
    """Tokens of a text, their tags, and the first tokens of its secrets."""
    tokens = [(m.start(), m.end(), m[0]) for m in _TOKEN.finditer(text)]
    tags, firsts = [O] * len(tokens), []
    for a, b in spans:
        own = [i for i, (s, e, _) in enumerate(tokens) if s < b and e > a]
        for i in own:
            tags[i] = B if i == own[0] and not tags[i] else I
        firsts += own[:1]
    return tokens, tags, firsts


def _snippets(text: str, raw: bytes, seed: int) -> list[tuple[list[list[int]], list[int]]]:
    """Training sequences of a text: the tokens around its secrets; around a place
    drawn by ``seed`` if it has none, and there once with a made-up secret and once
    with look-alikes in it."""
    import random

    tokens, tags, centres = _tagged(text, secrets_of(text))
    if not tokens:
        return []
    file = file_features(raw)
    if centres:
        return [_sequence(tokens, tags, c, file) for c in centres[:4]]
    centre = seed % len(tokens)
    out = [_sequence(tokens, tags, centre, file)]
    near = tokens[max(0, centre - AROUND) : centre + AROUND]
    at = tokens[centre][0]
    left, right = text[near[0][0] : at], text[at : near[-1][1]]
    rng = random.Random(seed)
    before, secret, after = made_up(rng)
    start = len(left) + 1 + len(before)
    tokens, tags, centres = _tagged(f"{left} {before}{secret}{after} {right}", [(start, start + len(secret))])
    out.append(_sequence(tokens, tags, centres[0], file))
    tokens, tags, _ = _tagged(" ".join([left, look_alike(rng), *right.split()[:2], look_alike(rng), right]), [])
    out.append(_sequence(tokens, tags, min(len(tokens) - 1, len(near) // 2 + 2), file))
    return out


# ---- decoding ---------------------------------------------------------------


def viterbi(unary: list, move: list, edge: int = O) -> list[int]:
    """The best tags of a run of tokens that stands between tokens tagged ``edge``."""
    best = [unary[0][k] + move[edge][k] for k in range(TAGS)]
    back = []
    for own in unary[1:]:
        choice = [max(range(TAGS), key=lambda j: best[j] + move[j][k]) for k in range(TAGS)]
        best = [best[choice[k]] + move[choice[k]][k] + own[k] for k in range(TAGS)]
        back.append(choice)
    k = max(range(TAGS), key=lambda j: best[j] + move[j][edge])
    tags = [k]
    for choice in reversed(back):
        k = choice[k]
        tags.append(k)
    return tags[::-1]


def _ends(word: str) -> tuple[str, str]:
    """The first and the last token of a word."""
    tokens = _TOKEN.findall(word)
    return (tokens[0], tokens[-1]) if tokens else ("", "")


class Tagger:
    """A model with its memos, for the texts of one task."""

    def __init__(self, model: Model):
        self.weights, self.move = model.weights, model.move.tolist()
        m = model.move
        # the most that a tag other than outside gains on it: by its two moves ...
        self.moves = float(max(m[p, x] + m[x, q] - m[p, O] - m[O, q] for p in range(TAGS) for q in range(TAGS) for x in (B, I)))
        # ... and by the neighbours and the text
        over = (model.weights - model.weights[:, :1]).reshape(-1, GROUP, TAGS).max(axis=1)
        self.rest = over[OWN:].sum(axis=0).tolist()
        self.vectors: dict = {}
        self.words: dict[str, int] = {}
        self.marks: dict[str, int] = {}
        self.forms: dict = {}
        first = [OWN * GROUP, (OWN + SIDE) * GROUP]  # neighbours' letters
        self.letter_weights = [[self.over(w) for w in model.weights[x : x + GROUP].tolist()] for x in first]
        self.table = None  # of words: see ``row``
        self.edges = [self.over(self.vector("", role)) for role in (1, 2)]

    def vector(self, token: str, role: int) -> list[float]:
        """Scores by tag: of the token itself (role 0), as left (1) or right (2) neighbour."""
        got = self.vectors.get((role, token))
        if got is None:
            if len(self.vectors) >= MEMO:
                self.vectors.clear()
            codes = side_features(token, role == 2) if role else own_features(token)
            got = self.vectors[role, token] = self.weights[codes].sum(axis=0).tolist()
        return got

    def _open(self, token: str) -> bool:
        """Whether some neighbours and text could make the token other than outside."""
        own = self.weights[own_features(token)].sum(axis=0).tolist()
        return max(own[x] - own[O] + self.rest[x] for x in (B, I)) + self.moves > 0

    def _token(self, token: str) -> bool:
        """``_open``, for letters of one case (but the first) and single signs by the
        little that their features depend on."""
        n = len(token)
        if n == 1:
            form = token
        elif token.isalpha() and n <= PIECE and (token[1:].islower() or all(map(str.isupper, token))):
            form = (token[0].isupper(), token[1].isupper(), n, len(set(token)))
            if n >= 12:
                form += (token[:4] if token[1].isupper() else "", token.strip("abcdef") == "")
        else:
            return self._open(token)
        got = self.forms.get((form,))
        if got is None:
            if len(self.forms) >= MEMO:
                self.forms.clear()
            got = self.forms[(form,)] = self._open(token)
        return got

    def mark(self, word: str) -> int:
        """1: tokens of the word may be part of a secret, whatever stands beside it; 2: base spans may begin in it."""
        got = any(map(self._token, _TOKEN.findall(word)))
        got = int(got) + 2 * bool(_HINT(word))
        if len(self.marks) >= MEMO:
            self.marks.clear()
        if len(word) < 100:
            self.marks[word] = got
        return got

    @staticmethod
    def over(scores: list[float]) -> tuple[float, float]:
        """What begin and inside have more than outside."""
        return scores[B] - scores[O], scores[I] - scores[O]

    def parts(self, token: str) -> tuple:
        """``over`` of the token itself, as left and as right neighbour. For letters of one case (but
        the first) by the little that these depend on, and the neighbours' letters."""
        n = len(token)
        if not (n > 1 and token.isalpha() and n <= PIECE and (token[1:].islower() or all(map(str.isupper, token)))):
            return tuple(self.over(self.vector(token, role)) for role in (0, 1, 2))
        form = (token[0].isupper(), token[1].isupper(), n, len(set(token)))
        if n >= 12:
            form += (token[:4] if token[1].isupper() else "", token.strip("abcdef") == "")
        got = self.forms.get(form)
        low = token.lower()
        if got is None:
            if len(self.forms) >= MEMO:
                self.forms.clear()
            own = self.over(self.vector(token, 0))
            sides = [self.weights[side_features(token, right)[1:]].sum(axis=0).tolist() for right in (False, True)]
            got = self.forms[form] = (own, *map(self.over, sides))
        (xb, xi), (yb, yi) = (self.letters(low if len(low) <= 12 else "", right) for right in (False, True))
        return got[0], (got[1][0] + xb, got[1][1] + xi), (got[2][0] + yb, got[2][1] + yi)

    def letters(self, low: str, right: bool) -> tuple[float, float]:
        """``over`` of a neighbour's letters."""
        import xxhash

        return self.letter_weights[right][xxhash.xxh32_intdigest(low) % GROUP]

    def row(self, word: str) -> tuple:
        """Of a word: its first token beside the second, its last beside the one before, the word as left and
        right neighbour (begin and inside over outside each), the most of the tokens between,
        whether it is one token, whether base spans may begin in it. One token is a first, without a right neighbour."""
        tokens = [self.parts(t) for t in _TOKEN.findall(word)] or [self.parts("")]
        plus = lambda *own: tuple(map(sum, zip(*own)))
        hint = bool(_HINT(word))
        if len(tokens) == 1:
            own, left, right = tokens[0]
            return *own, -1e9, -1e9, *left, *right, -1e9, 1.0, hint
        first, last = plus(tokens[0][0], tokens[1][2]), plus(tokens[-1][0], tokens[-2][1])
        between = max((max(plus(b[0], a[1], c[2])) for a, b, c in zip(tokens, tokens[1:], tokens[2:])), default=-1e9)
        return *first, *last, *tokens[-1][1], *tokens[0][2], between, 0.0, hint

    def numbers(self, words: list[str]) -> list[int]:
        """The words' rows in the table."""
        import numpy as np

        found = list(map(self.words.get, words))
        if None not in found:
            return found
        if len(self.words) >= MEMO:
            self.words.clear()
            found = [None] * len(words)
        fresh = dict.fromkeys(w for w, i in zip(words, found) if i is None)
        at = len(self.words)
        if self.table is None or at + len(fresh) > len(self.table):
            table = np.zeros((max(2 * (at + len(fresh)), 1 << 12), 11))
            table[:at] = self.table[:at] if at else 0
            self.table = table
        self.table[at : at + len(fresh)] = [self.row(w) for w in fresh]
        self.words.update(zip(fresh, range(at, at + len(fresh))))
        return list(map(self.words.get, words))

    def spans(self, text: str, raw: bytes) -> list[tuple[int, int, str]]:
        """All spans of a text, by start, then kind: the base ones, and those of the
        best tags that touch none of them."""
        import numpy as np

        words = text.split()
        if not words:
            return []
        numbers = self.numbers(words)
        rows = self.table.take(numbers, axis=0)
        left, right = np.empty((len(words), 2)), np.empty((len(words), 2))
        left[0], left[1:] = self.edges[0], rows[:-1, 4:6]
        right[-1], right[:-1] = self.edges[1], rows[1:, 6:8]
        scores = self.weights[file_features(raw)].sum(axis=0).tolist()
        file = np.array(self.over(scores))
        most = np.maximum(rows[:, 0:2] + left + right * rows[:, 9:10], rows[:, 2:4] + right) + file
        most = np.maximum(most.max(axis=1), rows[:, 8] + file.max())
        marks = np.flatnonzero(most > -self.moves - 1e-9).tolist()
        found = base_spans(text) if rows[:, 10].any() else []
        if marks:
            taken = [(a, b) for a, b, _ in found]
            found += [(a, b, "crf") for a, b in self.tagged(text, raw, words, marks) if all(b <= c or a >= d for c, d in taken)]
            found.sort(key=lambda s: (s[0], KINDS.index(s[2])))
        return found

    def tagged(self, text: str, raw: bytes, words: list[str], marks: list[int]) -> list[tuple[int, int]]:
        """The spans of the best tags, given the numbers of the words that may hold any."""
        file = self.weights[file_features(raw)].sum(axis=0).tolist()
        runs: list[list] = []  # neighbouring tokens that may be other than outside: (start, end, scores)
        at, follows = 0, None  # follows: (word, token) that would go on the last run
        for i in marks:
            w = words[i]
            while True:  # the word's next place, between white space
                at = text.index(w, at)
                end = at + len(w)
                if (at == 0 or text[at - 1].isspace()) and (end == len(text) or text[end].isspace()):
                    break
                at += 1
            tokens = [(m.start() + at, m.end() + at, m[0]) for m in _TOKEN.finditer(w)]
            before = _ends(words[i - 1])[1] if i else ""
            after = _ends(words[i + 1])[0] if i + 1 < len(words) else ""
            for n, (a, b, token) in enumerate(tokens):
                left = tokens[n - 1][2] if n else before
                right = tokens[n + 1][2] if n + 1 < len(tokens) else after
                parts = (self.vector(token, 0), self.vector(left, 1), self.vector(right, 2), file)
                scores = [sum(v) for v in zip(*parts)]
                if max(scores[B], scores[I]) - scores[O] + self.moves <= 0:
                    continue
                if follows != (i, n):
                    runs.append([])
                runs[-1].append((a, b, scores))
                follows = (i, n + 1) if n + 1 < len(tokens) else (i + 1, 0)
            at = end
        out: list[list[int]] = []
        for run in runs:
            for (a, b, _), tag in zip(run, viterbi([r[2] for r in run], self.move)):
                if tag == I and out and out[-1][1] == a:
                    out[-1][1] = b
                elif tag != O:
                    out.append([a, b])
        return [tuple(s) for s in out]


# ---- over tables ------------------------------------------------------------


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Model | None:
    """A model learned from ``sample`` texts that hold a base span and as many that
    hold none, each kind the first by a hash of the id, one for each id. None without
    any token."""
    import pickle

    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"), F.xxhash64(f"`{doc_id}`").alias("h"))
    rows = rows.filter(F.col("text").isNotNull())
    held = F.col("text").rlike("AKIA[A-Z0-9]{14}|(?i:passw|secret|token|api_?key)[^\\n]{0,16}[:=]|[0-9a-f]{16}")
    keys = rows.select("id", "h", held.alias("held"))
    place = F.row_number().over(Window.partitionBy("held").orderBy("h", "id"))
    first = lambda k: stored(k.withColumn("place", place).filter(F.col("place") <= sample).select(F.col("id").alias("chosen"), "held"), "chosen")
    chosen = first(keys.filter(F.col("h") < -(1 << 63) + (1 << 64) // HASH_SHARE))
    if chosen.filter("held").count() < sample or chosen.filter("NOT held").count() < sample:
        chosen = first(keys)  # too few of a kind among the lowest hashes: the first of all
    picked = rows.join(F.broadcast(chosen.select("chosen").distinct()), F.col("id") == F.col("chosen")).select("h", "text")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for part in pieces(batch, 100):
                own = zip(part.column(0).to_pylist(), part.column(1).to_pylist(), byte_values(part.column(1)))
                out = [(h, sorted(pickle.dumps(s) for s in _snippets(t, r, h))) for h, t, r in own]
                yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.list_(pa.binary()))], names=["h", "s"])

    found = picked.mapInArrow(run, "h long, s array<binary>").groupBy("h").agg(F.min("s").alias("s")).collect()
    found = [pickle.loads(bytes(s)) for r in sorted(found, key=lambda r: r.h) for s in r.s]
    return train(found) if any(any(tags) for _, tags in found) else None


def scan(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The rows of ``docs`` (in ``row``) with ``spans``: start, end (code points, end
    exclusive) and kind, by start, then kind as in ``KINDS``. Null texts are empty.
    Without a model there are the base spans alone."""
    import numpy as np

    if model is None:  # outside is always best
        model = Model(np.array([[0.0, -1.0, -1.0]]).repeat(BUCKETS, axis=0), np.zeros((TAGS, TAGS)))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.struct("*").alias("row"), F.col(f"`{text}`").alias("text"))

    def run(batches):
        import pyarrow as pa

        tagger = Tagger(shared.value)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
        for batch in batches:
            for part in pieces(batch, 500):
                texts = part.column(1).to_pylist()
                spans = [tagger.spans(t or "", r) for t, r in zip(texts, byte_values(part.column(1)))]
                spans = [[{"start": a, "end": b, "kind": k} for a, b, k in own] for own in spans]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(spans, kind)], names=["row", "spans"])

    schema = widen(rows.select("row").schema, "spans array<struct<start: bigint, end: bigint, kind: string>>")
    return rows.mapInArrow(run, schema)


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``scan`` by a model fitted on ``docs``. Rows that repeat are scanned each by
    itself; an empty table gives an empty result."""
    return scan(docs, fit(docs, doc_id, text), text)


def joined(spans, kinds: tuple = KINDS):
    """kind:start:end of the spans of ``kinds``, comma-joined."""
    own = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(own, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
