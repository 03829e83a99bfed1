"""Personal data in whole texts: exact patterns, and spans that a trained tagger adds."""

from __future__ import annotations

import functools
import re
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_caches, portions
from .tagger import KINDS, PAD, Tagger, classes, labelled_lines, train

# The patterns of the base kinds; an e-mail's local part is taken from the left of its sign.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: What any number of the base kinds stands in, and signs of an e-mail in other spellings.
NUMBERS = re.compile(r"[+(0-9][+0-9 ().-]{6,}+")
SPELT = re.compile(r"[\[({] ?at ?[\])}]| @ | at ")
AT = re.compile(r"[\[({] ?at ?[\])}]")
RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}+")
DOTTED = re.compile(r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]")
SECRET = re.compile(r"(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9+/_=-]{16,}")
WEIGHTS = Path(__file__).with_name("tagger.npz")
WIDTH, OVERLAP = 512, 96  # of the tagger's windows: each character but a text's first and last has 48 more around it
BATCH, CHARS = 512, 500_000  # windows decoded at once; characters of texts handled at once, unless one text has more


def digits_of(s: str) -> str:
    return "".join([c for c in s if "0" <= c <= "9"])


def luhn(digits: str) -> bool:
    back = [int(c) for c in reversed(digits)]
    return (sum(back[::2]) + sum([d * 2 - 9 * (d > 4) for d in back[1::2]])) % 10 == 0


def valid(kind: str, s: str) -> bool:
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in s.split(".")) if s.count(".") == 3 and all(p.isascii() and p.isdigit() for p in s.split(".")) else False
    if kind == "card":
        return 13 <= len(d := digits_of(s)) <= 19 and luhn(d)
    if kind == "phone":
        return 9 <= len(digits_of(s)) <= 15
    return True


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The leftmost spans of each kind that do not overlap, without those that fail their check, by kind and start. Each
    pattern takes time in proportion to the text."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start, least = at, end
        while start > least and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            end = m.end()
            out.append(("email", start, end))
        else:
            end = max(end, at + 1)
        at = text.find("@", max(at + 1, end))
    found: dict[str, list] = {"ip": [], "card": [], "phone": []}
    for m in NUMBERS.finditer(text):
        for kind, pattern in (("ip", IP), ("card", CARD), ("phone", PHONE)):
            found[kind] += [(kind, s.start(), s.end()) for s in pattern.finditer(text, m.start(), m.end()) if valid(kind, s[0])]
    return out + found["ip"] + found["card"] + found["phone"]


def windows(n: int) -> list[tuple[int, int, int, int]]:
    """Overlapping windows over a whole text of n characters: start and end, and the part that is kept of each, which is
    where no other window has the character further from its edge."""
    out, start = [], 0
    while n:
        last = start + WIDTH >= n
        end = n if last else start + WIDTH
        out.append((start, end, start + OVERLAP // 2 if start else 0, n if last else end - OVERLAP // 2))
        if last:
            break
        start += WIDTH - OVERLAP
    return out


def needed(text: str) -> list[tuple[int, int]]:
    """Places of which each span that added_spans finds sound meets one, whatever the tagger says: an e-mail holds a sign, a
    secret lies in a long run with letters and digits, numbers in a run with nine digits or four dotted parts."""
    out = [m.span() for m in AT.finditer(text)]
    for sign in ("@", " at "):
        at = text.find(sign)
        while at >= 0:
            out.append((at, at + len(sign)))
            at = text.find(sign, at + 1)
    out += [m.span() for m in RUN.finditer(text) if SECRET.fullmatch(text, m.start(), m.end())]
    return out + [m.span() for m in NUMBERS.finditer(text) if len(digits_of(m[0])) >= 9 or DOTTED.search(m[0])]


def meeting(n: int, places: list[tuple[int, int]]) -> set[int]:
    """Numbers of the windows over n characters of whose kept parts a place meets one."""
    lows = np.array([w[2] for w in windows(n)])
    out: set[int] = set()
    for a, b in places:
        out.update(range(int(np.searchsorted(lows, a, side="right")) - 1, int(np.searchsorted(lows, b - 1, side="right"))))
    return out


def tags_of(texts: list[str], model: Tagger, places: list[list[tuple[int, int]]] | None = None) -> list[np.ndarray]:
    """The tag of each character of each text. Windows of all texts are decoded together, those of a length side by side.
    With places only windows that meet one are decoded, and those beside them into which a tagged span may go on, until it
    ends: the spans that meet a place are those of all windows, and what meets none may be missing."""
    out = [np.zeros(len(t), np.uint8) for t in texts]
    cut = [windows(len(t)) for t in texts]
    todo = {(k, j) for k, w in enumerate(cut) for j in (range(len(w)) if places is None else meeting(len(texts[k]), places[k]))}
    codes: dict[int, np.ndarray] = {}
    done: set[tuple[int, int]] = set()
    while todo:
        for k in {k for k, _ in todo} - codes.keys():
            codes[k] = np.concatenate([classes(texts[k][i : i + CHARS]) for i in range(0, len(texts[k]), CHARS)])
        order = sorted(((k, *cut[k][j]) for k, j in todo), key=lambda p: (p[2] - p[1], p))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            x = np.full((max(b - a for _, a, b, _, _ in some), len(some)), PAD, np.uint8)
            for j, (k, a, b, _, _) in enumerate(some):
                x[: b - a, j] = codes[k][a:b]
            decoded = np.ascontiguousarray(model.decode(x).T)
            for j, (k, a, _, low, high) in enumerate(some):
                out[k][low:high] = decoded[j, low - a : high - a]
        done |= todo
        before = {(k, j - 1) for k, j in todo if j and out[k][cut[k][j][2]]}
        after = {(k, j + 1) for k, j in todo if j + 1 < len(cut[k]) and out[k][cut[k][j][3] - 1]}
        todo = (before | after) - done
    return out


def tagged_spans(texts: list[str], model: Tagger, places: list[list[tuple[int, int]]] | None = None) -> list[list[tuple[str, int, int]]]:
    """Spans of the tagger in each whole text, across windows: a span goes on while tags stay inside its kind. With places,
    all spans that meet one, and perhaps others."""
    out = []
    for tags in tags_of(texts, model, places):
        spans: list[list] = []
        for i in np.flatnonzero(tags).tolist():
            tag = int(tags[i])
            kind = KINDS[(tag - 1) // 2]
            if tag % 2 or not spans or spans[-1][0] != kind or spans[-1][2] != i:
                spans.append([kind, i, i + 1])
            else:
                spans[-1][2] = i + 1
        out.append([tuple(s) for s in spans])
    return out


def added_spans(text: str, tagged: list[tuple[str, int, int]], base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The tagger's spans that are sound and touch no base span: numbers pass their kind's check, telephone numbers have
    separators, e-mails a sign and a host, secrets letters and digits and no part of a word beside them."""
    out, taken = [], sorted((a, b) for _, a, b in base)
    for kind, a, b in tagged:
        while a < b and text[a] in " .,;:\n\"'":
            a += 1
        while a < b and text[b - 1] in " .,;:\n(-\"'":
            b -= 1
        s = text[a:b]
        if kind == "email":
            sound = ("@" in s or SPELT.search(s)) and len(s) >= 6 and "\n" not in s and re.search(r"(\.|\bdot\b)\W*[A-Za-z]{2,}\Z", s)
        elif kind == "secret":
            sound = SECRET.fullmatch(s) and not (b < len(text) and text[b].isalnum()) and not (a and text[a - 1].isalnum())
        else:
            sound = valid(kind, s) and not re.search(r"[^0-9 ().+-]", s) and (kind != "phone" or len(re.findall(r"[ ().-]+", s)) >= 2) and not (b < len(text) and text[b].isdigit()) and not (a and text[a - 1].isdigit())
        if sound and not any(x < b and a < y for x, y in taken):
            out.append((kind, a, b))
    return out


@functools.lru_cache(1)
def default_tagger() -> Tagger:
    """Trained by this module's tagger on made-up lines alone; `python -m cellweave.llm.pii` trains it again."""
    with np.load(WEIGHTS) as f:
        return Tagger({k: f[k] for k in f.files})


def ordered(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join([f"{k}:{a}:{b}" for k, a, b in spans])


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind; of overlapping spans the union is, by the first one's kind."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def find(df: DataFrame, model: Tagger | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, base and spans as text lists, base counts by kind, and the redacted text.

    Patterns read every character of every text (null: empty, redacted null), the tagger every window in which a span of
    its own could be sound (needed), which gives the spans that it gives over all windows. Some texts are read at a time,
    so memory is bounded by the longest text; offsets count code points. Base spans stay as the patterns give them; the
    tagger adds spans, of a fifth kind too, that touch none of them. Repeated rows give equal results, a null id stays
    null, other columns are left out, the empty table gives no rows.
    """
    model = model or default_tagger()

    def run(batches):
        drop_caches()
        for some in portions(batches, "text", CHARS):
            given = some["text"].to_pylist()
            texts = [t or "" for t in given]
            base = [base_spans(t) for t in texts]
            all_ = [ordered(b + added_spans(t, g, b)) for t, g, b in zip(texts, tagged_spans(texts, model, [needed(t) for t in texts]), base, strict=True)]
            yield pa.RecordBatch.from_arrays([
                some["doc_id"], *[pa.array([sum(s[0] == kind for s in b) for b in base], pa.int64()) for kind in KINDS[:4]],
                pa.array([listed(b) for b in base]), pa.array([listed(s) for s in all_]),
                pa.array([None if g is None else redacted(t, s) for g, t, s in zip(given, texts, all_, strict=True)], pa.string()),
            ], ["doc_id", *[f"n_{kind}" for kind in KINDS[:4]], "base", "spans", "redacted"])

    return df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, spans string, redacted string"
    )


def redact(df: DataFrame, model: Tagger | None = None, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """df with each span of its texts, base or added, replaced by its kind, and length_col, if there, by the new length.
    Null texts stay null, all other columns and repeated rows as they are; the empty table gives no rows."""
    model = model or default_tagger()

    def run(batches):
        drop_caches()
        for some in portions(batches, text_col, CHARS):
            given = some[text_col].to_pylist()
            texts = [t or "" for t in given]
            base = [base_spans(t) for t in texts]
            new = [redacted(t, b + added_spans(t, g, b)) for t, g, b in zip(texts, tagged_spans(texts, model, [needed(t) for t in texts]), base, strict=True)]
            columns = {name: some[name] for name in some.schema.names}
            columns[text_col] = pa.array([n if g is not None else None for n, g in zip(new, given, strict=True)], some[text_col].type)
            if length_col in columns:
                changed = [len(n) if n != t else old for n, t, old in zip(new, texts, some[length_col].to_pylist(), strict=True)]
                columns[length_col] = pa.array(changed, some[length_col].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return df.mapInArrow(run, df.schema)


def train_default() -> None:
    """Writes the weights that default_tagger reads."""
    np.savez_compressed(WEIGHTS, **train(labelled_lines(12_000), steps=3000).p)


if __name__ == "__main__":
    train_default()
