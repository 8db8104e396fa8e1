"""Personal data: base patterns, and spans added by a semi-Markov conditional random field over whole segments."""

from __future__ import annotations

import random
import re
from bisect import bisect_right
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
OUTSIDE = 4
#: Documents the field is fitted on, the first by a hash of their id; base spans and numbers taken from them.
TRAINING_DOCS = 2000
TRAINING_SPANS = 300
STEPS = 30
RATE = 0.2
RIDGE = 0.01
#: Longest entity in tokens (stretches of digits, or parts of an address), and in address characters on a side.
MAX_TOKENS, MAX_ADDRESS = 20, 80

# The dealt base patterns and limits. The address is searched from its sign, whose left side can't hold
# another; the number patterns start where a stretch of digits does, as every leftmost match does.
_EMAIL_RIGHT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_EMAIL_LEFT = re.compile(r"[A-Za-z0-9._%+-]+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS = (16, 19), (8, 15)

_DIGITS = re.compile(r"[0-9]+")
_SEPARATOR = r"[  ().\-/_+\[\]]"
_NUMBERS = re.compile(rf"[0-9]++(?:{_SEPARATOR}{{1,3}}[0-9]++)*+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_AT_OPEN, _AT_CLOSE = r"\s?[\[({<]\s?", r"\s?[\])}>]\s?"
_AT = re.compile(rf"\s?@\s?|{_AT_OPEN}at{_AT_CLOSE}", re.I)
_AT_WORD = re.compile(r"\s?@\s?|\sat\s", re.I)
_AT_ALL = re.compile(rf"{_AT.pattern}|\sat\s", re.I)
_DOT_WORD = re.compile(r"\sdot\s", re.I)
_DOT = rf"(?:\s?\.\s?|{_AT_OPEN}dot{_AT_CLOSE}|\sdot\s)"
_LABEL = re.compile(r"[A-Za-z0-9-]+")
_DOTTED = re.compile(rf"[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+){{1,5}}", re.I)
_BEFORE_LOCAL = re.compile(rf"(?:[A-Za-z0-9_%+-]+{_DOT}){{1,2}}\Z", re.I)
_CUES = {
    PHONE: re.compile(r"(?:tel|phone|call|fax|mobile|cell|whatsapp)[\w.]{0,6}[\s:#.]{0,3}\Z", re.I),
    CARD: re.compile(r"(?:card|visa|mastercard|credit|carte|tarjeta|karte)[\w.]{0,6}[\s:#.]{0,3}\Z", re.I),
    IP: re.compile(r"(?:ip|host|server|address|adresse)[\w.]{0,6}[\s:#.]{0,3}\Z", re.I),
}


def luhn(digits: str) -> bool:
    """Whether the check digit is right."""
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        total += value if place % 2 == 0 else 2 * value - 9 * (value > 4)
    return total % 10 == 0


def _is_ip(text: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0")[:4] or 0) <= 255 for part in text.split("."))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of all base matches, by kind and start. Time is linear in the text."""
    found, end = [], 0
    if "@" in text:
        for right in _EMAIL_RIGHT.finditer(text):
            at = right.start()
            since = max(end, text.rfind("@", end, at) + 1)
            left = _EMAIL_LEFT.match(text[since:at][::-1])
            if left:
                end = right.end()
                found.append((EMAIL, at - left.end(), end))
    found += [(IP, m.start(), m.end()) for m in _IP.finditer(text) if _is_ip(m[0])]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= CARD_DIGITS[0]:
            digits = m[0].replace(" ", "").replace("-", "")
            if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
                found.append((CARD, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if PHONE_DIGITS[0] <= sum(map(len, _DIGITS.findall(m[0]))) <= PHONE_DIGITS[1]:
                found.append((PHONE, m.start(), m.end()))
    return found


# Candidate segments. An island is a stretch of tokens that may hold entities; a candidate is (first token, token after
# the last, kind, features, start, end). What lies outside all islands can't be labelled.

#: What a whole segment can show, and its weight before training.
PRIOR = {
    "email": -2.0, "email at sign": 1.0, "email at in brackets": 3.0, "email at word": 0.0, "email dot in brackets": 2.0,
    "email dot word": 1.5, "email dots plain": 0.5, "email dots spaced": -2.5, "email styles differ": -0.5,
    "email short ending": 2.0, "email long ending": -1.5, "email ending with digits": -3.0, "email ending with capital": -3.0,
    "email more labels": 0.3, "email local with dot": 0.5, "email local with digit": 0.5, "email label follows": -1.5,
    "ip": -3.0, "ip parts fit": 3.0, "ip part too large": -6.0, "ip dots": 2.0, "ip dots in brackets": 3.5, "ip dots spaced": 1.0,
    "ip other separators": -6.0, "ip leading zero": -1.0, "ip tight neighbour": -5.0, "ip cue": 1.0, "ip touches a letter": -3.0,
    "ip spaced neighbour": 0.0,
    "card": -4.0, "card check digit": 6.0, "card check digit wrong": -6.0, "card one stretch": 0.5, "card groups of four": 1.5,
    "card uneven groups": -2.5, "card mixed separators": -2.0, "card odd separators": -0.5, "card tight neighbour": -3.0,
    "card spaced neighbour": 0.0, "card cue": 1.0, "card touches a letter": -3.0,
    "phone": -4.0, "phone plus": 3.0, "phone brackets": 3.0, "phone three three four": 5.0, "phone prefix three three four": 4.5,
    "phone one stretch": -2.0, "phone two stretches": -0.5, "phone many stretches": 0.0, "phone nine digits or less": -1.0,
    "phone over twelve digits": -2.0, "phone mixed separators": -0.5, "phone slashes": -2.5, "phone dots": -0.5,
    "phone date": -6.0, "phone tight neighbour": -4.0, "phone spaced neighbour": -0.5, "phone cue": 2.0,
    "phone touches a letter": -3.0, "phone single digits": -3.0,
}
FEATURES = {f: i for i, f in enumerate(PRIOR)}


def _date(groups: tuple[int, ...]) -> bool:
    return groups[:3] in ((4, 2, 2), (2, 2, 4), (4, 1, 2), (4, 2, 1), (1, 2, 4), (2, 1, 4), (1, 1, 4), (4, 1, 1), (2, 2, 2))


def _shape_features(kind: int, groups: tuple, seps: tuple, passes: bool, zero: bool, opened: str) -> tuple[str, ...]:
    """Features that follow from stretch lengths, what separates them, the kind's arithmetic test and what opens it."""
    own = KINDS[kind]
    shown = [own]
    if kind == IP:
        shown.append("ip parts fit" if passes else "ip part too large")
        if all(s == "." for s in seps):
            shown.append("ip dots")
        elif all(s in ("[.]", "(.)") for s in seps):
            shown.append("ip dots in brackets")
        elif all(s.strip() == "." for s in seps):
            shown.append("ip dots spaced")
        else:
            shown.append("ip other separators")
        if zero:
            shown.append("ip leading zero")
        return tuple(shown)
    if len(set(seps)) > 1 and not (kind == PHONE and opened == "("):
        shown.append(f"{own} mixed separators")
    if kind == CARD:
        shown.append("card check digit" if passes else "card check digit wrong")
        if not seps:
            shown.append("card one stretch")
        elif all(g == 4 for g in groups[:-1]) and groups[-1] <= 4:
            shown.append("card groups of four")
        else:
            shown.append("card uneven groups")
        if any(s not in (" ", "-") for s in seps):
            shown.append("card odd separators")
        return tuple(shown)
    digits = sum(groups)
    if opened == "+":
        shown.append("phone plus")
    brackets = any("(" in s for s in seps) and any(")" in s for s in seps) or opened == "(" and bool(seps) and ")" in seps[0]
    if brackets:
        shown.append("phone brackets")
    if groups == (3, 3, 4):
        shown.append("phone three three four")
    elif len(groups) == 4 and groups[1:] == (3, 3, 4) and groups[0] <= 4:
        shown.append("phone prefix three three four")
    elif len(groups) == 1:
        shown.append("phone one stretch")
    elif len(groups) == 2:
        shown.append("phone two stretches")
    else:
        shown.append("phone many stretches")
    if digits <= 9:
        shown.append("phone nine digits or less")
    if digits > 12:
        shown.append("phone over twelve digits")
    if any("/" in s or "_" in s or "[" in s for s in seps):
        shown.append("phone slashes")
    elif any("." in s for s in seps):
        shown.append("phone dots")
    if _date(groups):
        shown.append("phone date")
    if sum(g == 1 for g in groups) > 1:
        shown.append("phone single digits")
    return tuple(shown)


@lru_cache(maxsize=65_536)
def _number_features(kind, groups, seps, passes, zero, opened, touches, tight, spaced, cue) -> tuple[int, ...]:
    own = KINDS[kind]
    near = (("touches a letter", touches), ("tight neighbour", tight), ("spaced neighbour", spaced), ("cue", cue))
    shown = [*_shape_features(kind, groups, seps, passes, zero, opened), *[f"{own} {x}" for x, there in near if there]]
    return tuple(FEATURES[f] for f in shown)


def number_island(text: str, start: int, end: int, taken: list[tuple[int, int]] = ()):
    """Number of tokens, and candidates, of a stretch of digits and separators; ``taken`` spans, in order, are left out."""
    runs = [m.span() for m in _DIGITS.finditer(text, start, end)]
    held, ends = [], [b for _, b in taken]  # per run: whether a taken span has part of it
    for s, e in runs:
        k = bisect_right(ends, s)
        held.append(k < len(taken) and taken[k][0] < e)
    seps = tuple(text[a[1] : b[0]] for a, b in zip(runs, runs[1:]))
    found, last = [], len(runs) - 1
    for i, (left, _) in enumerate(runs):
        digits, whole, groups = 0, "", ()
        before = text[left - 1 : left]
        for j in range(i, min(last + 1, i + MAX_TOKENS)):
            s, right = runs[j]
            digits += right - s
            if held[j] or digits > CARD_DIGITS[1]:
                break
            whole += text[s:right]
            groups += (right - s,)
            kinds = []
            if j - i == 3 and max(groups) <= 3:
                kinds.append(IP)
            if digits >= CARD_DIGITS[0]:
                kinds.append(CARD)
            if PHONE_DIGITS[0] <= digits <= PHONE_DIGITS[1]:
                kinds.append(PHONE)
            for kind in kinds:
                opened, first, inner = "", left, seps[i:j]
                if kind == PHONE:
                    if before == "+" or before == "(":
                        opened, first = before, left - 1
                        if before == "(" and text[max(0, left - 2) : left - 1] == "+":
                            opened, first = "+", left - 2
                        k = bisect_right(ends, first)
                        if k < len(taken) and taken[k][0] < left:
                            continue
                    if opened != "(" and any(")" in x for x in inner) and not any("(" in x for x in inner):
                        continue
                passes = zero = False
                if kind == CARD:
                    passes = luhn(whole)
                elif kind == IP:
                    parts = [text[a:b] for a, b in runs[i : j + 1]]
                    passes = all(int(p) <= 255 for p in parts)
                    zero = any(p[0] == "0" and len(p) > 1 for p in parts)
                touches = first == left and before.isalnum() or text[right : right + 1].isalnum()
                sides = (seps[i - 1].removesuffix(opened) if i else " ", seps[j] if j < last else " ")
                tight = any(x.strip() or not x for x in sides)
                spaced = not tight and (i > 0 or j < last)
                cue = i == 0 and bool(_CUES[kind].search(text[max(0, first - 16) : first]))
                features = _number_features(kind, groups, inner, passes, zero, opened, touches, tight, spaced, cue)
                found.append((i, j + 1, kind, features, first, right))
    return len(runs), found


def _style(joint: str) -> str:
    bare = joint.strip()
    if bare in ("@", "."):
        return "spaced" if bare != joint else "plain"
    return "word" if bare.isalpha() else "bracket"


def address_island(text: str, at: re.Match, taken: list[tuple[int, int]] = ()):
    """Number of tokens, and candidates, of what may be an address around a sign or word for it."""
    since = max(0, at.start() - MAX_ADDRESS)
    local = _LOCAL.match(text[since : at.start()][::-1])
    domain = _DOTTED.match(text, at.end(), at.end() + 2 * MAX_ADDRESS)
    if not local or not domain:
        return 0, []
    # Tokens: up to two spelled parts before the name, the name, the labels of the domain.
    starts = [at.start() - local.end()]
    earlier = _BEFORE_LOCAL.search(text, since, starts[0])
    if earlier:
        starts = [m.start() for m in _LABEL.finditer(text, earlier.start(), starts[0]) if m[0].lower() != "dot"] + starts
    labels, joints, place = [], [], at.end()
    for m in _LABEL.finditer(text, at.end(), domain.end()):
        joint = text[place : m.start()]
        if labels and m[0].lower() == "dot" and "dot" not in joint.lower() and m.end() < domain.end():
            continue
        if labels:
            joints.append(joint)
        labels.append((m[0], m.end()))
        place = m.end()
    sign = _style(at[0])
    found = []
    for i, first in enumerate(starts):
        name = text[first : at.start()]
        for j in range(1, len(labels)):
            styles = {_style(s) for s in joints[:j]}
            last, end = labels[j]
            if any(a < end and first < b for a, b in taken):
                continue
            shown = ["email"]
            shown.append({"plain": "email at sign", "spaced": "email at sign", "bracket": "email at in brackets"}.get(sign, "email at word"))
            named = {"plain": "email dots plain", "spaced": "email dots spaced", "bracket": "email dot in brackets", "word": "email dot word"}
            shown += [named[s] for s in sorted(styles)]
            if len(styles) > 1:
                shown.append("email styles differ")
            if any(c.isdigit() for c in last):
                shown.append("email ending with digits")
            elif any(c.isupper() for c in last) and not last.isupper():
                shown.append("email ending with capital")
            else:
                shown.append("email short ending" if 2 <= len(last) <= 4 else "email long ending")
            if j > 1:
                shown.append("email more labels")
            if "." in name or i < len(starts) - 1:
                shown.append("email local with dot")
            if any(c.isdigit() for c in name):
                shown.append("email local with digit")
            if j + 1 < len(labels):
                shown.append("email label follows")
            found.append((i, len(starts) + j + 1, EMAIL, tuple(FEATURES[f] for f in shown), first, end))
    return len(starts) + len(labels), found


def islands(text: str, base: list[tuple[int, int, int]]):
    """(number of tokens, candidates) of every island that has candidates; base spans are not part of any."""
    taken = sorted((s, e) for _, s, e in base)
    edge = 0
    for m in _NUMBERS.finditer(text):
        start, end = m.span()
        if end - start < 7:
            continue
        while edge < len(taken) and taken[edge][1] <= start:
            edge += 1
        near, k = [], edge
        while k < len(taken) and taken[k][0] < end:
            near.append(taken[k])
            k += 1
        if near and near[0][0] <= start and near[0][1] >= end:
            continue
        size, found = number_island(text, start, end, near)
        if found:
            yield size, found
    spelled = _DOT_WORD.search(text)
    brackets = any(b in text for b in "[({<")
    if not spelled and not brackets and "@" not in text:
        return
    signs = _AT_ALL if spelled and brackets else _AT_WORD if spelled else _AT
    edge = 0
    for at in signs.finditer(text):
        while edge < len(taken) and taken[edge][1] <= at.start() - MAX_ADDRESS:
            edge += 1
        near, k = [], edge
        while k < len(taken) and taken[k][0] < at.end() + 2 * MAX_ADDRESS:
            near.append(taken[k])
            k += 1
        if any(a < at.end() and at.start() < b for a, b in near):
            continue
        word = _style(at[0]) == "word"
        size, found = address_island(text, at, near)
        if word:  # a plain word for the sign needs a spelled dot behind it
            found = [c for c in found if FEATURES["email dot word"] in c[3] or FEATURES["email dot in brackets"] in c[3]]
        if found:
            yield size, found


class Field:
    """Weights of the features, and of a kind (or outside) following another."""

    def __init__(self, weights=None, moves=None):
        self.weights = np.array(list(PRIOR.values())) if weights is None else weights
        self.moves = np.zeros((5, 5)) if moves is None else moves
        self.known: dict[tuple[int, ...], float] = {}

    def score(self, features: tuple[int, ...]) -> float:
        score = self.known.get(features)
        if score is None:
            score = self.known[features] = float(self.weights[list(features)].sum())
        return score

    def decode(self, size: int, candidates: list) -> list[tuple[int, int, int]]:
        """The best joint choice of segments, as (kind, start, end); ties go to leaving out."""
        moves = self.moves.tolist()
        ending: dict[int, list] = {}
        for c in candidates:
            ending.setdefault(c[1], []).append((self.score(c[3]), c))
        best = [[None] * 5 for _ in range(size + 1)]
        best[0][OUTSIDE] = (0.0, None, None)
        entered: list[dict] = [{} for _ in range(size + 1)]

        def enter(place: int, label: int):
            held = entered[place].get(label)
            if held is None:
                held = max(
                    ((state[0] + moves[y][label], y) for y, state in enumerate(best[place]) if state is not None),
                    key=lambda x: (x[0], x[1]),
                )
                entered[place][label] = held
            return held

        for place in range(1, size + 1):
            score, y = enter(place - 1, OUTSIDE)
            best[place][OUTSIDE] = (score, y, None)
            for own, c in ending.get(place, ()):
                score, y = enter(c[0], c[2])
                held = best[place][c[2]]
                if held is None or score + own > held[0]:
                    best[place][c[2]] = (score + own, y, c)
        place, label = size, max(range(5), key=lambda y: (best[size][y][0] if best[size][y] else float("-inf"), y))
        chosen = []
        while place > 0:
            _, y, c = best[place][label]
            if c is not None:
                chosen.append((c[2], c[4], c[5]))
            place, label = (c[0] if c is not None else place - 1), y
        return chosen[::-1]


def spans(text: str | None, field: Field) -> list[tuple[int, int, int, bool]]:
    """(kind, start, end, whether base) by kind and start; null as empty."""
    if not text:
        return []
    base = base_spans(text)
    added = [s for size, found in islands(text, base) for s in field.decode(size, found)]
    taken, last = [], -1
    for s in sorted(added, key=lambda s: (s[1], -s[2])):  # islands around neighbouring signs may overlap
        if s[1] >= last:
            taken.append(s)
            last = s[2]
    return sorted([(*s, True) for s in base] + [(*s, False) for s in taken])


# Training.


def log_likelihood(weights, moves, examples):
    """Mean log-likelihood of the marked segmentations, and its gradient by weights and moves.

    An example is (number of tokens, candidates as (first, after, kind, features), places of the right candidates).
    """
    total, slope, turn = 0.0, np.zeros_like(weights), np.zeros_like(moves)
    for size, candidates, right in examples:
        own = [float(weights[list(c[3])].sum()) for c in candidates]
        ending: list[list[int]] = [[] for _ in range(size + 1)]
        for n, c in enumerate(candidates):
            ending[c[1]].append(n)
        forward = np.full((size + 1, 5), -np.inf)
        forward[0, OUTSIDE] = 0.0
        into = np.empty((size + 1, 5))
        for place in range(size + 1):
            if place:
                forward[place, OUTSIDE] = into[place - 1, OUTSIDE]
                for n in ending[place]:
                    c = candidates[n]
                    forward[place, c[2]] = np.logaddexp(forward[place, c[2]], into[c[0], c[2]] + own[n])
            into[place] = np.logaddexp.reduce(forward[place][:, None] + moves, axis=0)
        whole = np.logaddexp.reduce(forward[size])
        backward = np.full((size + 1, 5), -np.inf)
        backward[size] = 0.0
        starting: list[list[int]] = [[] for _ in range(size + 1)]
        for n, c in enumerate(candidates):
            starting[c[0]].append(n)
        for place in range(size - 1, -1, -1):
            steps = [(OUTSIDE, backward[place + 1, OUTSIDE], None)]
            steps += [(candidates[n][2], own[n] + backward[candidates[n][1], candidates[n][2]], n) for n in starting[place]]
            for label, ahead, n in steps:
                through = moves[:, label] + ahead
                chance = np.exp(forward[place] + through - whole)
                turn[:, label] -= chance
                if n is not None:
                    slope[list(candidates[n][3])] -= chance.sum()
                backward[place] = np.logaddexp(backward[place], through)
        at, label = 0, OUTSIDE
        for n in [*sorted(right, key=lambda n: candidates[n][0]), None]:
            until = size if n is None else candidates[n][0]
            while at < until:
                total += moves[label, OUTSIDE]
                turn[label, OUTSIDE] += 1
                at, label = at + 1, OUTSIDE
            if n is not None:
                kind = candidates[n][2]
                total += moves[label, kind] + own[n]
                turn[label, kind] += 1
                slope[list(candidates[n][3])] += 1
                at, label = candidates[n][1], kind
        total -= whole
    n = max(len(examples), 1)
    return total / n, slope / n, turn / n


def _disguises(rng: random.Random, kind: int, span: str) -> list[str]:
    """Other ways to write a base span, which the base patterns miss."""
    digits = "".join(_DIGITS.findall(span))
    if kind == EMAIL:
        name, _, host = span.partition("@")
        at, dot = rng.choice([(" [at] ", " [dot] "), (" (at) ", " (dot) "), (" at ", " dot "), ("[at]", "."), (" @ ", "."), ("(at)", ".")])
        return [name + at + host.replace(".", dot)]
    if kind == IP:
        return [span.replace(".", rng.choice(["[.]", "(.)", " . "]))]
    if kind == CARD:
        joint = rng.choice([".", "/", " ", "_", " - "])
        return [joint.join(digits[i : i + 4] for i in range(0, len(digits), 4))]
    a, b, c = digits[-10:-7] or "212", digits[-7:-4], digits[-4:]
    return [rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"1-{a}-{b}-{c}", f"00{digits[:-10] or 1} {a} {b} {c}", f"({a}) {b} {c}"])]


def _decoys(rng: random.Random) -> list[str]:
    """Numbers that are no personal data."""

    def number(n):
        return "".join(rng.choice("123456789") for _ in range(n))

    wrong = number(15)
    wrong += next(d for d in "0123456789" if not luhn(wrong + d))
    day = f"{rng.randrange(1900, 2100)}-{rng.randrange(1, 13):02}-{rng.randrange(1, 29):02}"
    return [
        wrong, " ".join(wrong[i : i + 4] for i in range(0, 16, 4)), number(8), number(10), number(12), f"{day} {number(2)}",
        day.replace("-", "/"), f"{day[8:]}.{day[5:7]}.{day[:4]}", f"{number(3)}.{number(3)}.{number(3)}.999",
        ".".join(number(1) for _ in range(6)), f"978-3-{number(2)}-{number(6)}-{number(1)}", f"{number(4)}-{number(4)}",
        " ".join(number(1) for _ in range(rng.randrange(9, 16))), f"{number(3)}/{number(5)}/{number(2)}", f"{number(1)}.{number(3)}.{number(3)}",
        " ".join(number(2) for _ in range(5)), f"{number(20)} {number(3)}",
    ]


def _example(text: str, marked: list[tuple[int, int, int]]):
    """Training examples of a text whose entities are known; a base span counts like any other."""
    for size, found in islands(text, []):
        places = {c[2:3] + c[4:]: n for n, c in enumerate(found)}
        inside = [m for m in marked if any(m[1] < c[5] and c[4] < m[2] for c in found)]
        right = [places[m] for m in inside if m in places]
        if len(right) == len(inside):
            yield size, found, right


def examples(pieces: list[tuple[int, str, str, str]], seed: int = 7) -> list:
    """From (kind or outside, left, span, right) of base spans and other numbers: as they are, disguised, side by side, decoys."""
    rng = random.Random(seed)
    made: list = []
    numbers = [p for p in pieces if p[0] in (IP, CARD, PHONE)]
    for kind, left, span, right in pieces:
        if kind == OUTSIDE:
            made += _example(f"{left}{span}{right}", [])
            continue
        for own in [span, *_disguises(rng, kind, span)]:
            if kind == EMAIL and own == span:
                continue
            start = len(left)
            made += _example(f"{left}{own}{right}", [(kind, start, start + len(own))])
        if kind != EMAIL and len(numbers) > 1:
            other, _, beside, _ = rng.choice(numbers)
            start = len(left)
            text = f"{left}{span} {beside}{right}"
            made += _example(text, [(kind, start, start + len(span)), (other, start + len(span) + 1, start + len(span) + 1 + len(beside))])
        made += [e for d in rng.sample(_decoys(rng), 5) for e in _example(f"{left}{d}{right}", [])]
    return made


def train(pieces: list[tuple[int, str, str, str]], steps: int = STEPS) -> Field:
    """Gradient ascent from the prior weights and towards them, each with a step size of its own; nothing to learn from leaves those."""
    made = examples(pieces)
    field = Field()
    if not made:
        return field
    prior = np.concatenate([field.weights, field.moves.ravel()])
    values, squares = prior.copy(), np.full(len(prior), 1e-6)
    for _ in range(steps):
        _, a, b = log_likelihood(values[: len(FEATURES)], values[len(FEATURES) :].reshape(5, 5), made)
        slope = np.concatenate([a, b.ravel()]) - RIDGE * (values - prior)
        squares += slope * slope
        values = values + RATE * slope / np.sqrt(squares)
    return Field(values[: len(FEATURES)], values[len(FEATURES) :].reshape(5, 5))


def _pieces(batches):
    for batch in batches:
        rows = []
        for text in batch.column("text").to_pylist():
            base = base_spans(text or "")
            covered = [(s, e) for _, s, e in base]
            rows += [(k, text[max(0, s - 20) : s], text[s:e], text[e : e + 20]) for k, s, e in base if e - s <= 200]
            for m in _NUMBERS.finditer(text or ""):
                s, e = m.span()
                if 7 <= e - s <= 60 and all(b <= s or e <= a for a, b in covered):
                    if not any(c[2] == CARD and FEATURES["card check digit"] in c[3] for c in number_island(text, s, e)[1]):
                        rows.append((OUTSIDE, text[max(0, s - 20) : s], m[0], text[e : e + 20]))
        columns = zip(*rows) if rows else [()] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.string(), pa.string(), pa.string()))],
            ["kind", "before", "span", "behind"],
        )


def fit(docs: DataFrame, limit: int = TRAINING_DOCS, most: int = TRAINING_SPANS) -> Field:
    """Learns from the base spans and other numbers of about ``limit`` documents; at most ``most`` of each reach the driver.

    Base spans are their own labels; they are also written in ways the base patterns miss and set beside each other
    and beside numbers that are no personal data, so that the field learns from their shape and surroundings.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    total = ids.count()
    share = ids.where(F.expr(f"pmod(xxhash64(doc_id), {max(1, total // limit)}) = 0")).select("text")
    found = share.mapInArrow(_pieces, "kind int, before string, span string, behind string").distinct()
    rows = []
    for test in (f"kind < {OUTSIDE}", f"kind = {OUTSIDE}"):
        rows += found.where(test).orderBy(F.xxhash64("span", "before"), "kind", "before", "span", "behind").limit(most).collect()
    return train([tuple(r) for r in rows])


_SPAN = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("text", pa.string()), ("base", pa.bool_())])
)


def _found(batches, field):
    for batch in batches:
        rows = [
            [dict(kind=KINDS[k], start=s, end=e, text=text[s:e], base=b) for k, s, e, b in spans(text, field)]
            for text in batch.column(1).to_pylist()
        ]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, _SPAN)], ["doc_id", "spans"])


def find_spans(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """doc_id and spans (kind, start, end, text, base; by kind, then start, in code points) of every row.

    Base spans are the leftmost non-overlapping matches of each kind's pattern that pass its test; spans of different
    kinds may overlap. The field adds spans beside them, none of which overlaps a base span or another: stretches of
    digits and separators, and spelled addresses, are cut into segments and labelled jointly. Whole texts; null and
    empty ones have no spans. Repeated rows and null ids repeat; no rows give none. One pass without a shuffle.
    """
    field = field or fit(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(
        lambda batches: _found(batches, field),
        "doc_id long, spans array<struct<kind: string, start: bigint, end: bigint, text: string, base: boolean>>",
    )


def redacted(text: str | None, field: Field) -> str | None:
    """The text with each span as its kind in brackets; of overlapping spans the first names the whole stretch."""
    if not text:
        return text
    parts, end = [], 0
    for start, stop, kind in sorted((s, e, k) for k, s, e, _ in spans(text, field)):
        if start >= end:
            parts += [text[end:start], f"[{KINDS[kind]}]"]
        end = max(end, stop)
    return "".join([*parts, text[end:]])


def redact(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """All columns of ``docs`` as they are, but personal data in ``text`` replaced; null texts stay null."""
    field = field or fit(docs)

    def replaced(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = pa.array([redacted(t, field) for t in batch.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([texts if i == at else c for i, c in enumerate(batch.columns)], batch.schema.names)

    return docs.mapInArrow(replaced, docs.schema)


def span_digests(found: DataFrame) -> DataFrame:
    """Counts of base spans by kind, the digest of the base spans, and all spans as text."""
    listed = "array_join(transform({}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"
    counts = [f"cast(size(filter(spans, s -> s.base AND s.kind = '{k}')) AS bigint) AS n_{k}" for k in KINDS]
    base = listed.format("filter(spans, s -> s.base)")
    return found.selectExpr("doc_id", *counts, f"sha2({base}, 256) AS base_sha256", f"{listed.format('spans')} AS spans")
