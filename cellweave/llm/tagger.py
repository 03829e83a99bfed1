"""A character-level bidirectional LSTM with CRF transitions, in numpy: training from labelled spans and decoding."""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

KINDS = ("email", "ip", "card", "phone", "secret")
TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind
PAD, DIGIT, LOWER, UPPER, OTHER = 0, 1, 2, 3, 4  # letters here are those beyond ASCII
NEVER = np.float32(-40.0)  # the score of a forbidden transition

Example = tuple[str, list[tuple[str, int, int]]]


def class_table() -> np.ndarray:
    """Character classes of code points below 0x250: each ASCII sign of its own, digits alike."""
    table = np.full(0x250, OTHER, np.uint8)
    for c in range(0x250):
        s = chr(c)
        if c < 128:
            table[c] = DIGIT if s.isdigit() else 5 + c
        else:
            table[c] = LOWER if s.islower() else UPPER if s.isupper() else OTHER
    return table


TABLE = class_table()
CLASSES = 5 + 128


def classes(text: str) -> np.ndarray:
    """One class for each code point."""
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    return np.where(codes < 0x250, TABLE[np.minimum(codes, 0x24F)], np.uint8(OTHER))


def allowed() -> np.ndarray:
    """0 where a tag may follow another, NEVER where not: an inside tag follows its own kind only."""
    out = np.zeros((TAGS, TAGS), np.float32)
    for k in range(2, TAGS, 2):
        out[:, k] = NEVER
        out[k - 1 : k + 1, k] = 0
    return out


ALLOWED = allowed()
FIRST = np.where((np.arange(TAGS) > 0) & (np.arange(TAGS) % 2 == 0), NEVER, np.float32(0))
ENTRY = np.array([0, *range(1, TAGS, 2)])  # tags that may follow any tag
INNER = np.arange(2, TAGS, 2)
ORDER = np.concatenate([ENTRY, INNER])  # of tags while decoding: those of one sort lie side by side


def steps_of(wx: np.ndarray, wh: np.ndarray, o: np.ndarray, x: np.ndarray, keep: list | None = None) -> Iterator[np.ndarray]:
    """What the output layer o says of the hidden states (ways, tags, batch) of each time over classes x (time, ways, batch).
    Padding closes all gates, so states are zero there. One product gives it with the next time's recurrent inputs. What is
    yielded is overwritten; keep gets what training needs."""
    ways, kinds, n4 = wx.shape
    n, batch = n4 // 4, x.shape[2]
    both, rows = (w.astype(np.float32, copy=False) for w in (np.concatenate([wh, o], 1), wx.reshape(-1, n4)))
    at = x.astype(np.intp) + np.arange(ways)[:, None] * kinds
    h, c = np.zeros((2, ways, n, batch), np.float32)
    z, a = np.empty((ways, both.shape[1], batch), np.float32), np.empty((ways, n4, batch), np.float32)
    given = np.empty((ways, batch, n4), np.float32)
    inner, said = z[:, :n4], z[:, n4:]
    i, f, out, g = (a[:, k * n : (k + 1) * n] for k in range(4))
    gates, half = a[:, : 3 * n], np.float32(0.5)
    for t in range(len(x)):
        np.matmul(both, h, out=z)
        if t:
            yield said
        rows.take(at[t], axis=0, out=given, mode="clip")
        np.copyto(a, given.transpose(0, 2, 1))
        a += inner
        np.tanh(a, out=a)
        gates *= half
        gates += half
        if keep is not None:
            last, before, new = h.copy(), c.copy(), g.copy()
        c *= f
        c += np.multiply(i, g, out=g)
        np.tanh(c, out=h)
        if keep is not None:
            keep.append((last, before, i.copy(), f.copy(), out.copy(), new, h.copy()))
        h *= out
    np.matmul(both, h, out=z)
    yield said


@dataclass
class Tagger:
    """Weights: wx are the gate inputs of both directions by class (way, class, 4 hidden), wh the recurrent ones (way, 4
    hidden, hidden); o (way, tags, hidden) and oc the output layer; t and t0 the scores of tag transitions and of first
    tags."""

    p: dict[str, np.ndarray]

    @staticmethod
    def fresh(hidden: int, seed: int) -> Tagger:
        rng = np.random.default_rng(seed)
        wx = rng.normal(0, 0.3, (2, CLASSES, 4 * hidden))
        wx[:, :, hidden : 2 * hidden] += 0.5
        p = {"wx": wx, "wh": rng.normal(0, 0.5 / np.sqrt(hidden), (2, 4 * hidden, hidden)), "o": rng.normal(0, 0.3, (2, TAGS, hidden)), "oc": np.zeros(TAGS), "t": np.zeros((TAGS, TAGS)), "t0": np.zeros(TAGS)}
        p = {k: v.astype(np.float32) for k, v in p.items()}
        close(p)
        return Tagger(p)

    def scores(self, x: np.ndarray, keep: list | None = None, tags: np.ndarray | slice = slice(None)) -> np.ndarray:
        """(time, tags, batch): what the network says of each tag of each character, or of some tags in their order."""
        o, oc = self.p["o"][:, tags], self.p["oc"][tags]
        e, last = np.zeros((len(x), len(oc), x.shape[1]), np.float32), len(x) - 1
        for t, said in enumerate(steps_of(self.p["wx"], self.p["wh"], o, np.stack([x, x[::-1]], 1), keep)):
            e[t] += said[0]
            e[last - t] += said[1]
        e += oc[:, None]
        return e

    def decode(self, x: np.ndarray) -> np.ndarray:
        """The best tag sequence (time, batch) by network and transitions; columns end with padding, whose tags mean
        nothing."""
        best, t = self.scores(x, tags=ORDER), (self.p["t"] + ALLOWED)[np.ix_(ORDER, ORDER)]
        n, m, batch = len(ENTRY), len(INNER), x.shape[1]
        entry = np.ascontiguousarray(t[:, :n])[:, :, None]
        begin, inside = t[np.arange(1, n), np.arange(n, n + m)][:, None], t[np.arange(n, n + m), np.arange(n, n + m)][:, None]
        best[0] += (self.p["t0"] + FIRST)[ORDER, None]
        live = x != PAD
        whole = live.all(1)
        sums, top, two, stay = (np.empty((*k, batch), best.dtype) for k in ((TAGS, n), (n,), (m,), (m,)))
        came = np.zeros(x.shape, bool)  # where a tag other than outside comes before outside
        for k in range(1, len(x)):  # scores of a tag become those of the best sequence that ends with it
            b, now = best[k - 1], best[k]
            np.add(b[:, None], entry, out=sums)
            sums.max(0, out=top)
            np.not_equal(top[0], sums[0, 0], out=came[k])
            now[:n] += top
            np.add(b[1:n], begin, out=two)
            np.add(b[n:], inside, out=stay)
            now[n:] += np.maximum(two, stay, out=two)
            if not whole[k]:
                np.copyto(now, b, where=~live[k])
        out = np.empty(x.shape, np.uint8)
        tag = best[-1].argmax(0)
        out[-1] = tag
        back = np.ascontiguousarray(t.T)
        came &= live
        turns, within = came.any(1), tag.any()
        for k in range(len(x) - 1, 0, -1):
            if within or turns[k]:  # else outside follows outside in all columns
                some = np.flatnonzero(came[k] | (tag > 0) & live[k])
                tag[some] = (best[k - 1][:, some].T + back[tag[some]]).argmax(1)
                within = tag.any()
            out[k - 1] = tag
        return ORDER.astype(np.uint8)[out]

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Negative log likelihood of tags y a character, and its gradients, by forward-backward and back-propagation."""
        p, keep = self.p, []
        e, live = self.scores(x, keep).transpose(0, 2, 1), x != PAD
        hidden = np.stack([o * tc for _, _, _, _, o, _, tc in keep])
        top = e.max(2, keepdims=True)
        ee, et = np.exp(e - top), np.exp(p["t"] + ALLOWED)
        steps, batch = x.shape
        a, b, norm = np.zeros_like(ee), np.ones_like(ee), np.ones((steps, batch, 1), np.float32)
        a[0] = ee[0] * np.exp(p["t0"] + FIRST)
        norm[0] = a[0].sum(1, keepdims=True)
        a[0] /= norm[0]
        for k in range(1, steps):
            a[k] = a[k - 1] @ et * ee[k]
            norm[k] = a[k].sum(1, keepdims=True)
            a[k] /= norm[k]
            if not live[k].all():
                off = ~live[k]
                a[k][off], norm[k][off] = a[k - 1][off], 1
        for k in range(steps - 2, -1, -1):
            b[k] = (b[k + 1] * ee[k + 1] / norm[k + 1]) @ et.T
            if not live[k + 1].all():
                off = ~live[k + 1]
                b[k][off] = b[k + 1][off]
        seen, row = max(int(live.sum()), 1), np.arange(batch)
        g = {k: np.zeros_like(v) for k, v in p.items()}
        loss = np.log(norm[:, :, 0]).sum() + top[:, :, 0][live].sum() - np.take_along_axis(e, y[:, :, None], 2)[:, :, 0][live].sum() - (p["t0"] + FIRST)[y[0]].sum()
        de = a * b
        de /= de.sum(2, keepdims=True)
        g["t0"] = de[0].sum(0) - np.bincount(y[0], minlength=TAGS)
        both = live[1:]
        left, right = a[:-1][both], (b[1:] * ee[1:] / norm[1:])[both]
        g["t"] = (left.T @ right) * et
        moves = np.zeros((TAGS, TAGS))
        np.add.at(moves, (y[:-1][both], y[1:][both]), 1.0)
        loss -= float((moves * (p["t"] + ALLOWED)).sum())
        g["t"] = (g["t"] - moves).astype(np.float32)
        de[np.arange(steps)[:, None], row, y] -= 1
        de *= live[:, :, None]
        g["oc"] = de.sum((0, 1))
        de = np.stack([de, de[::-1]], 1)
        g["o"] = np.einsum("twbk,twhb->wkh", de, hidden, optimize=True)
        n = p["wh"].shape[2]
        dh_all = (de @ p["o"]).transpose(0, 1, 3, 2)
        dh, dc = np.zeros((2, 2, n, batch), np.float32)
        dz_all = np.empty((steps, 2, 4 * n, batch), np.float32)
        back = p["wh"].transpose(0, 2, 1)
        for t in range(steps - 1, -1, -1):
            last, before, i, f, o, gg, tc = keep[t]
            dh = dh + dh_all[t]
            dc = dc + dh * o * (1 - tc**2)
            dz = dz_all[t]
            dz[:, :n], dz[:, n : 2 * n] = dc * gg * i * (1 - i) * 2, dc * before * f * (1 - f) * 2
            dz[:, 2 * n : 3 * n], dz[:, 3 * n :] = dh * tc * o * (1 - o) * 2, dc * i * (1 - gg**2)
            g["wh"] += dz @ last.transpose(0, 2, 1)
            dh, dc = back @ dz, dc * f
        for way, xs in enumerate((x, x[::-1])):
            order = np.argsort(xs.ravel(), kind="stable")
            found, starts = np.unique(xs.ravel()[order], return_index=True)
            g["wx"][way][found] = np.add.reduceat(dz_all[:, way].transpose(0, 2, 1).reshape(-1, 4 * n)[order], starts)
        g["wx"][:, PAD] = 0
        return float(loss / seen), {k: v / seen for k, v in g.items()}


def close(p: dict[str, np.ndarray]) -> None:
    """Padding shuts the gates of input, memory and output. (Gate inputs are halves of a logistic function's argument.)"""
    n = p["wh"].shape[2]
    p["wx"][:, PAD, : 3 * n], p["wx"][:, PAD, 3 * n :] = -30, 0


def arrays(examples: list[Example], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(time, examples) classes and tags of labelled texts, cut or padded to width."""
    x, y = np.zeros((width, len(examples)), np.int64), np.zeros((width, len(examples)), np.int64)
    for k, (text, spans) in enumerate(examples):
        code = classes(text)[:width]
        x[: len(code), k] = code
        for kind, start, end in spans:
            tag = 1 + 2 * KINDS.index(kind)
            y[start : start + 1, k], y[start + 1 : end, k] = tag, tag + 1
    return x, y


def train(examples: list[Example], width: int = 96, hidden: int = 12, steps: int = 800, batch: int = 64, rate: float = 0.02, seed: int = 4) -> Tagger:
    """Adam on minibatches of labelled spans; the same examples and seed give the same weights."""
    model, rng = Tagger.fresh(hidden, seed), np.random.default_rng(seed)
    x, y = arrays(examples, width)
    m = {k: np.zeros_like(v) for k, v in model.p.items()}
    v = {k: np.zeros_like(w) for k, w in model.p.items()}
    for step in range(1, steps + 1):
        some = rng.choice(len(examples), batch)
        _, g = model.gradients(x[:, some], y[:, some])
        now = rate * min(1.0, step / 20) * (1 - step / (steps + 20))
        for k in model.p:
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            v[k] = 0.99 * v[k] + 0.01 * g[k] ** 2
            model.p[k] -= (now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        close(model.p)
    return model


class Lines:
    """Made-up lines with labelled personal data and secrets in many spellings, and numbers and signs that are none."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def some(self, letters: str, low: int, high: int) -> str:
        return "".join(self.r.choices(letters, k=self.r.randint(low, high)))

    def digits(self, n: int) -> str:
        return "".join(self.r.choices("0123456789", k=n))

    def name(self) -> str:
        return self.some("abcdefghijklmnopqrstuvwxyz", 3, 8)

    def email(self) -> str:
        r = self.r
        user = (self.name() + r.choice(["", ".", "_", "-", "+"]) + r.choice([self.name(), self.digits(2), ""])).strip("._-+")
        host, top = r.choice([self.name(), self.name() + self.digits(1)]), r.choice(["com", "org", "net", "de", "fr", "es", "io", "co"])
        at, dot = r.choice([("@", "."), ("@", "."), ("(at)", "."), (" (at) ", "."), ("[at]", "."), (" [at] ", " [dot] "), ("{at}", "(dot)"), (" @ ", "."), (" at ", " dot ")])
        return user + at + host + dot + (self.name() + dot if r.random() < 0.3 else "") + top

    def phone(self) -> str:
        a, b, c = self.digits(3), self.digits(3), self.digits(4)
        return self.r.choice([
            f"+1 ({a}) {b}-{c}", f"+{self.digits(2)} {a} {b}{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"+1-{a}-{b}-{c}", f"1-{a}-{b}-{c}", f"({a}) {b} {c}", f"00{self.digits(2)} {a} {b} {c}",
        ])

    def ip(self) -> str:
        return ".".join(str(self.r.randint(0, 255)) for _ in range(4))

    def card(self) -> str:
        """Sixteen digits, the last of which makes the check sum right (a wrong one is none, which only the check tells)."""
        return self.r.choice(["", " ", "-"]).join(self.digits(4) for _ in range(4))

    def secret(self) -> str:
        hexes, all_ = self.r.choice(["0123456789abcdef", "0123456789ABCDEF"]), "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
        return self.r.choice([self.some(hexes, 32, 40), self.some(hexes, 40, 40), self.some(all_, 24, 40), "AKIA" + self.some(all_[:26] + all_[52:], 16, 16), "ghp_" + self.some(all_, 36, 36)])

    def keyed(self) -> tuple[str, str]:
        """What stands before a secret and after it."""
        key = self.r.choice(["token", "api_key", "apikey", "secret", "password", "access_key", "auth_token", "key"])
        if self.r.random() < 0.3:
            key = key.upper()
        quote = self.r.choice(['"', '"', "'", ""])
        return key + self.r.choice([" = ", "=", ": ", " : ", " := "]) + quote, quote

    def none(self) -> str:
        d, r = self.digits, self.r
        return r.choice([
            f"{r.randint(1900, 2030)}-{d(2)}-{d(2)}", f"{d(1)}.{d(2)}.{d(1)}", d(r.randint(2, 11)), f"{d(2)}/{d(2)}/{d(4)}", f"{d(1)},{d(3)},{d(3)}.{d(2)}", f"{d(2)}:{d(2)}:{d(2)}", f"@{self.name()}",
            f"{d(4)}-{d(4)}", f"({d(4)})", d(r.randint(20, 26)), "(at)", f"{d(6)} {d(6)}", f"v{d(1)}.{d(1)}.{d(2)}", f"https://{self.name()}.com/{self.name()}/{d(4)}", f"commit {self.some('0123456789abcdef', 40, 40)}",
            f"sha256:{self.some('0123456789abcdef', 64, 64)}", f"{self.name()}_{d(3)}", f"x{d(1)} = {d(2)}.{d(3)}", f"{self.name()}({self.name()})", f"{d(3)} | {d(3)} | {d(3)}", f"key = {self.name()}", f"token {self.name()}",
            f"{self.name()} at {self.name()}", f"{self.name()} dot {self.name()}", f"{d(1)}) {self.name()}", "#" * r.randint(1, 6), "..." , f"{d(2)}%", f"${d(3)}.{d(2)}", f"[{d(2)}]", "!!", "== " + self.name() + " ==",
        ])

    def word(self) -> str:
        w = self.some(self.r.choice(["abcdefghiklmnoprstuvwy", "abcdefghiklmnoprstuvwxyzäéñöüßçèêóí"]), 1, 10)
        return self.r.choice([w, w, w, w.capitalize(), w.upper()])

    def line(self, width: int) -> Example:
        r, text, spans = self.r, "", []
        often = r.choice([0.0, 0.1, 0.3, 0.6])
        odd = r.choice([0.02, 0.15, 0.4])
        while len(text) < width:
            after = ""
            if r.random() < often:
                kind = r.choice(KINDS)
                if kind == "secret":
                    before, after = self.keyed()
                    text += before
                piece = getattr(self, kind)()
                spans.append((kind, len(text), len(text) + len(piece)))
            else:
                piece = self.none() if r.random() < odd else self.word()
            text += piece + after + r.choice([" ", " ", " ", " ", ". ", ", ", "\n", " | ", "; "])
        return text, spans


def labelled_lines(n: int, seed: int = 9, width: int = 96) -> list[Example]:
    lines = Lines(seed)
    return [lines.line(width) for _ in range(n)]
