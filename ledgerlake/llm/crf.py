"""A small linear-chain conditional random field over word-shape features, in numpy.

Tokens are words. A word's shape class is drawn from its bytes alone (kinds of character, digit count, length,
marks such as ``@`` or ``+``) and a token's score comes from the classes of the word and its two neighbours on
either side. Training minimises the regularised negative log likelihood by full-batch gradient steps (Adam)
on a small labelled table that is made from templates; decoding is Viterbi over many lines at once.
"""

from __future__ import annotations

import numpy as np

from . import common as C

KINDS = ("email", "ip", "card", "phone", "secret")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
N_LABELS = len(LABELS)
OFFSETS = (-2, -1, 0, 1, 2)

# Cue words by kind, lower case, without closing punctuation
CUES = {
    "email": ("email", "e-mail", "mail", "mailto", "correo", "courriel"),
    "ip": ("ip", "host", "address", "server", "adresse"),
    "card": ("card", "visa", "mastercard", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "telephone", "telefon", "fax", "mobile", "telefono"),
    "secret": ("token", "password", "passwd", "pwd", "secret", "api_key", "apikey", "api-key", "key", "bearer", "passwort", "contrasena"),
    "at": ("at", "(at)", "[at]"),
    "dot": ("dot", "(dot)", "[dot]"),
}


def _hashes(words: list[str]) -> np.ndarray:
    raw = [w.encode() for w in words]
    off = np.cumsum([0, *map(len, raw)])
    return C.range_hashes(np.frombuffer(b"".join(raw), np.uint8), off[:-1], off[1:])


_names = [(w, k) for k, group in enumerate(CUES.values()) for w in group]
_cue_keys = _hashes([w for w, _ in _names])
_cue_order = np.argsort(_cue_keys)
_CUE_KEYS, _CUE_KINDS = _cue_keys[_cue_order], np.array([k for _, k in _names])[_cue_order]

_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_ALPHA = np.zeros(256, bool)
_ALPHA[65:91] = _ALPHA[97:123] = True
_ALPHA[128:] = True
_TAIL = np.zeros(256, bool)
_TAIL[list(b".,;:!?=\"")] = True
_JOIN = np.zeros(256, bool)
_JOIN[list(b"=:")] = True
_QUOTE = np.zeros(256, bool)
_QUOTE[list(b"\"'")] = True
LONG = 12

# 0 edge, 1 plain, 2 capitalised, 3 marks, 4 and 5 with @, 6 an assignment's mark, 7 quoted, 8 a cue and its value in one word
_CUE = 9
N_CLASSES = _CUE + len(CUES) + 7 * 4 * 2 * 2 * 2


def shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The shape class of every word; 0 stands for the line's edge."""
    if len(starts) == 0:
        return np.zeros(0, np.int64)

    def count(flag):
        total = np.zeros(len(data) + 1, np.int64)
        np.cumsum(flag, out=total[1:])
        return total[ends] - total[starts]

    digits, alpha = count(_DIGIT[data]), count(_ALPHA[data])
    first = data[starts]
    at, dots, plus = count(data == 64) > 0, count(data == 46), first == 43
    paren = first == 40
    size = ends - starts
    # words without digits: plain ones and cues
    out = np.where((first >= 65) & (first <= 90), 2, 1)
    out = np.where(alpha == 0, 3, out)
    out = np.where(at, np.where(dots > 0, 5, 4), out)
    out = np.where((digits == 0) & (alpha > 0) & _QUOTE[first] & (size >= LONG), 7, out)
    joins = count(_JOIN[data])
    out = np.where((alpha == 0) & (digits == 0) & (joins > 0), 6, out)
    trimmed = ends - _TAIL[data[ends - 1]]
    lower = C.LOWER[data]
    short = np.flatnonzero((digits == 0) & (size <= 12) & (trimmed > starts) & (alpha > 0))
    if len(short):
        out[short] = np.where((kind := _cue(lower, starts[short], trimmed[short])) >= 0, _CUE + kind, out[short])
    # words with digits
    step = np.searchsorted([2, 3, 4, 5, 9, 12], digits, "right")
    kind = np.where(alpha == 0, 0, np.where(at, 1, np.where(size < LONG, 2, 3)))
    full = ((((step * 4 + kind) * 2 + plus) * 2 + paren) * 2) + (dots - (data[ends - 1] == 46) >= 1)
    out = np.where(digits > 0, _CUE + len(CUES) + full, out)
    # a cue, an equals sign or a colon, and more
    both = np.flatnonzero((joins > 0) & (alpha > 0) & (size > 6))
    if len(both):
        marks = np.flatnonzero(_JOIN[data])
        cut = marks[np.searchsorted(marks, starts[both])]
        kind = _cue(lower, starts[both], cut)
        out[both[(kind == list(CUES).index("secret")) & (ends[both] - cut > 4)]] = 8
    return out


def _cue(lower: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The kind of cue that some bytes are; -1: none."""
    h = C.range_hashes(lower, starts, ends)
    k = np.minimum(np.searchsorted(_CUE_KEYS, h), len(_CUE_KEYS) - 1)
    return np.where(_CUE_KEYS[k] == h, _CUE_KINDS[k], -1)


# ---------------------------------------------------------------- the labelled table

_FILL = "the of and to in is on for with that was are this we he she it please see send or und der die das ist nicht mit les des est pour dans que los las una por con more text then after before some note".split()


def labelled_table(n: int = 600, seed: int = 5) -> list[tuple[list[str], list[str]]]:
    """(words, labels) of made-up lines: personal data and secrets in plain and spelled-out forms, and lines with other numbers and codes."""
    rng = np.random.default_rng(seed)
    digits = lambda k: "".join(str(rng.integers(0, 10)) for _ in range(k))
    pick = lambda xs: xs[int(rng.integers(len(xs)))]

    def name():
        return "".join(pick("abcdefghiklmnoprstuvw") for _ in range(int(rng.integers(3, 9))))

    def code(k):
        chars = pick(["0123456789abcdef", "0123456789ABCDEF", "abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ0123456789", "abcdefgh0123456789-_"])
        return pick("abcdef") * int(rng.random() < 0.2) + "".join(pick(chars) for _ in range(k)) + pick("0123456789")

    def entity(kind):
        if kind == "email":
            plain = [f"{name()}.{digits(2)}@{name()}.{pick(['example.com', 'org', 'net'])}"]
            at, dot = pick([("(at)", "(dot)"), ("[at]", "[dot]"), ("at", "dot")])
            return pick([plain, [name(), at, name(), dot, pick(["com", "org", "net"])]])
        if kind == "ip":
            return [".".join(str(rng.integers(1, 256)) for _ in range(4))]
        if kind == "secret":
            quoted = pick(['"', '"', "'", ""])
            return [quoted + code(int(rng.integers(10, 48))) + quoted]
        if kind == "card":
            return pick([[pick("456") + digits(15)], [digits(4) for _ in range(4)]])
        return pick([[f"+{rng.integers(1, 99)}", f"({digits(3)})", f"{digits(3)}-{digits(4)}"], [f"({digits(3)})", f"{digits(3)}-{digits(4)}"], [f"{digits(3)}-{digits(3)}-{digits(4)}"], [f"+{digits(11)}"], ["0" + digits(3), digits(6)]])

    def other():
        return pick([[digits(1) + "."], [digits(2)], ["19" + digits(2)], ["20" + digits(2) + "."], [digits(1) + "." + digits(1) + "."], [f"{digits(1)}.{digits(2)}"], [digits(5)], ["A" + digits(1) + "B" + digits(3)], ["v" + digits(1) + "." + digits(1)], [digits(3), digits(2)], [f"{digits(4)}-{digits(2)}-{digits(2)}"], ['"' + code(8) + '"'], [code(int(rng.integers(8, 40)))], ["#" + code(7)], ["token"], ["the", "secret", "of"], ["key", "=", pick(_FILL)], ["password", "is"], [digits(7)], ["Version", digits(1) + "." + digits(1) + "."], ["at"], ["at", "the"], ["dot"], ["call"], ["the", "card"], ["mail"]])

    table = []
    for _ in range(n):
        words, labels = [], []

        def add(ws, kind=None):
            for i, w in enumerate(ws):
                words.append(w)
                labels.append("O" if kind is None else f"{'BI'[i > 0]}-{kind}")

        for _ in range(int(rng.integers(1, 4))):
            add([pick(_FILL) if rng.random() < 0.8 else name() for _ in range(int(rng.integers(1, 9)))])
            u = rng.random()
            if u < 0.45:
                kind = pick(KINDS)
                ent = entity(kind)
                bare = kind == "phone" and not ent[0].startswith("+")
                cue = pick(CUES[kind])
                cue = cue.upper() if rng.random() < 0.2 else cue
                if kind == "secret" and rng.random() < 0.3:
                    ent = [cue + pick("=:") + ent[0]]
                elif kind == "secret":
                    add(pick([[cue, "="], [cue, ":"], [cue + ":"], [cue + "="], [cue, "is"], [cue]]))
                elif bare or rng.random() < 0.3:
                    add([cue + pick(["", ":"])])
                add([*ent[:-1], ent[-1] + pick(["", "", ".", ",", "!!"])], kind)
            elif u < 0.8:
                add(other())
        add([pick(_FILL) for _ in range(int(rng.integers(0, 5)))])
        table.append((words, labels))
    return table


def encoded(table: list[tuple[list[str], list[str]]]) -> tuple[np.ndarray, np.ndarray]:
    """(classes, labels), a padded row each; label -1 is padding."""
    width = max((len(w) for w, _ in table), default=1)
    x, y = np.zeros((len(table), width), np.int64), np.full((len(table), width), -1)
    for i, (words, labels) in enumerate(table):
        raw = [w.encode() for w in words]
        off = np.cumsum([0, *map(len, raw)])
        x[i, : len(words)] = shapes(np.frombuffer(b"".join(raw), np.uint8), off[:-1], off[1:])
        y[i, : len(words)] = [LABELS.index(a) for a in labels]
    return x, y


# ---------------------------------------------------------------- the model


def _allowed() -> np.ndarray:
    """0 where label b may follow a, else a large penalty: I-k only after B-k or I-k."""
    ok = np.zeros((N_LABELS, N_LABELS))
    for b, name in enumerate(LABELS):
        if name[0] == "I":
            for a, prior in enumerate(LABELS):
                if prior[0] == "O" or prior[2:] != name[2:]:
                    ok[a, b] = -1e4
    return ok


_START = np.array([-1e4 if name[0] == "I" else 0.0 for name in LABELS])


def emissions(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Scores [row, token, label] of padded class rows."""
    pad = np.pad(x, ((0, 0), (2, 2)))
    n = x.shape[1]
    return sum(w[k][pad[:, 2 + o : 2 + o + n]] for k, o in enumerate(OFFSETS))


def _logsum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return np.log(np.exp(a - top).sum(axis=axis)) + top.squeeze(axis)


def train(table: list[tuple[list[str], list[str]]], steps: int = 50, rate: float = 0.3, l2: float = 2e-4) -> tuple[np.ndarray, np.ndarray]:
    """(weights [offset, class, label], transitions)."""
    x, y = encoded(table)
    real = y >= 0
    rows, n = x.shape
    pad = np.pad(x, ((0, 0), (2, 2)))
    onehot = np.eye(N_LABELS)[np.maximum(y, 0)] * real[..., None]
    params = [np.zeros((len(OFFSETS), N_CLASSES, N_LABELS)), np.zeros((N_LABELS, N_LABELS))]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    seen = np.einsum("rta,rtb->ab", onehot[:, :-1], onehot[:, 1:])
    for step in range(1, steps + 1):
        w, t = params
        tr = t + _allowed()
        e = emissions(x, w)
        alpha = np.zeros((rows, n, N_LABELS))
        beta = np.zeros((rows, n, N_LABELS))
        alpha[:, 0] = e[:, 0] + _START
        for i in range(1, n):
            nxt = _logsum(alpha[:, i - 1, :, None] + tr, 1) + e[:, i]
            alpha[:, i] = np.where(real[:, i, None], nxt, alpha[:, i - 1])
        z = _logsum(alpha[:, -1], 1)
        for i in range(n - 2, -1, -1):
            back = _logsum(tr + (e[:, i + 1] + beta[:, i + 1])[:, None, :], 2)
            beta[:, i] = np.where(real[:, i + 1, None], back, 0.0)
        p = np.exp(alpha + beta - z[:, None, None]) * real[..., None]
        pair = np.exp(alpha[:, :-1, :, None] + tr + (e[:, 1:] + beta[:, 1:])[:, :, None, :] - z[:, None, None, None]) * real[:, 1:, None, None]
        gap = (p - onehot) / rows
        gw = np.zeros_like(w)
        for k, o in enumerate(OFFSETS):
            at = pad[:, 2 + o : 2 + o + n][real]
            for b in range(N_LABELS):
                gw[k, :, b] = np.bincount(at, gap[real][:, b], N_CLASSES)
        for k, g in enumerate((gw + l2 * w, (pair.sum((0, 1)) - seen) / rows + l2 * t)):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            params[k] = params[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return params[0].astype(np.float32), (params[1] + _allowed()).astype(np.float32)


def viterbi(x: np.ndarray, n: np.ndarray, w: np.ndarray, tr: np.ndarray) -> np.ndarray:
    """Best labels of padded class rows, of which row r has n[r] tokens."""
    e = emissions(x, w)
    rows, width = x.shape
    back = np.zeros((rows, width, N_LABELS), np.int8)
    best = e[:, 0] + _START
    for i in range(1, width):
        live = n > i
        into = best[:, :, None] + tr
        back[:, i] = into.argmax(1)
        best = np.where(live[:, None], into.max(1) + e[:, i], best)
    out = np.zeros((rows, width), np.int8)
    now = best.argmax(1)
    r = np.arange(rows)
    for i in range(width - 1, -1, -1):
        live = n > i
        out[live, i] = now[live]
        if i:
            now = np.where(live, back[r, i, now], now)
    return out
