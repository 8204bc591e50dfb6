"""What a page's own style sheets say of ``display`` and ``visibility`` on a screen.

Comments are dropped, blocks of at-rules count only where they hold for :data:`SCREEN`, and rules
override one another by importance, layer, specificity and order.  Selectors of one element are
known: its name, classes, id and attributes that it must have.  Rules with other selectors, that is
pseudo-classes and combinators, and blocks of ``@container`` and ``@scope`` say nothing here.
"""

from __future__ import annotations

import re
from collections.abc import Callable

# The screen that media queries are asked about.
SCREEN = {
    "width": 1280.0, "height": 800.0, "device-width": 1280.0, "device-height": 800.0, "aspect-ratio": 1.6,
    "device-aspect-ratio": 1.6, "resolution": 1.0, "color": 8.0, "monochrome": 0.0, "color-index": 0.0, "grid": 0.0,
    "orientation": "landscape", "hover": "hover", "any-hover": "hover", "pointer": "fine", "any-pointer": "fine",
    "prefers-color-scheme": "light", "prefers-reduced-motion": "no-preference", "prefers-contrast": "no-preference",
    "forced-colors": "none", "inverted-colors": "none", "scripting": "enabled", "update": "fast",
    "overflow-block": "scroll", "overflow-inline": "scroll", "display-mode": "browser", "color-gamut": "srgb",
    "dynamic-range": "standard",
}
UNITS = {"": 1, "px": 1, "em": 16, "rem": 16, "in": 96, "cm": 96 / 2.54, "mm": 96 / 25.4, "pt": 96 / 72, "pc": 16,
         "dppx": 1, "x": 1, "dpi": 1 / 96, "dpcm": 2.54 / 96}

_IGNORED = re.compile(
    r"""/\*.*?(?:\*/|\Z)|<!--|-->|"(?:\\.|[^"\\\n])*+"?|'(?:\\.|[^'\\\n])*+'?|url\(\s*+[^"')]*+\)""", re.S | re.I
)
_NAME = r"(?:[\w-]|\\[0-9a-fA-F]{1,6}\s?|\\.)+"
_COMPOUND = re.compile(rf"(\*|{_NAME})?((?:[.#]{_NAME}|\[\s*[\w-]+\s*\])*)")
_PART = re.compile(rf"([.#])({_NAME})|\[\s*([\w-]+)\s*\]")
_INNER = re.compile(r"\(([^()]*)\)")
_NUMBER = re.compile(r"([0-9]*\.?[0-9]+)\s*([a-z]*)(?:\s*/\s*([0-9]*\.?[0-9]+))?")
_DISPLAY = re.compile(
    r"none|block|inline|flow|flow-root|contents|list-item|run-in|math|initial|inherit|unset|-(?:webkit|moz|ms)-[a-z-]+"
    r"|(?:inline-)?(?:block|flex|grid|table)|table-[a-z-]+|ruby(?:-[a-z-]+)?"
)
_VISIBILITY = {"visible": "visible", "initial": "visible", "hidden": "hidden", "collapse": "collapse"} | dict.fromkeys(
    ("inherit", "unset", "revert", "revert-layer"), "inherit"
)

# Importance, whether it is the element's own style, layer, ids, classes, names, order; and the value.
Ranked = tuple[tuple[int, ...], str]
Said = dict[str, Ranked]


def _joined(words: list[str]) -> bool | None:
    """The truth of evaluated conditions and media types; None if it is not known."""
    negated = words[:1] == ["not"]
    words = words[1:] if negated or words[:1] == ["only"] else words
    known = {"true": True, "false": False, "unknown": None, "all": True, "screen": True}
    values = [known.get(w, False) for w in words[::2]]
    if not values or len(words) % 2 == 0 or "not" in words or len({*words[1::2]} | {"and", "or"}) > 2:
        return None
    few = "or" in words[1::2]
    value = few if few in values else None if None in values else not few
    return value if value is None else value != negated


def _feature(text: str) -> bool | None:
    """Whether a media feature holds for the screen; None if it is not known."""

    def number(value: str) -> float | None:
        m = _NUMBER.fullmatch(value.strip())
        if not m or m[2] not in UNITS or m[3] and not float(m[3]):
            return None
        return float(m[1]) * UNITS[m[2]] / float(m[3] or 1)

    def compare(a: float | None, how: str, b: float | None) -> bool | None:
        if a is None or b is None:
            return None
        return {"<": a < b, "<=": a <= b, ">": a > b, ">=": a >= b, "=": abs(a - b) < 1e-9}[how]

    def side(value: str) -> float | None:
        mine = SCREEN.get(value.strip())
        return mine if isinstance(mine, float) else number(value)

    text = text.strip()
    if ":" in text:
        name, _, value = (x.strip() for x in text.partition(":"))
        how = {"min-": ">=", "max-": "<="}.get(name[:4], "=")
        mine = SCREEN.get(name[4:] if how != "=" else name)
        if isinstance(mine, str):
            return mine == value if how == "=" else None
        return compare(mine, how, number(value))
    parts = re.split(r"(<=|>=|<|>|=)", text)
    if len(parts) > 1:
        found = [compare(side(parts[i]), parts[i + 1], side(parts[i + 2])) for i in range(0, len(parts) - 2, 2)]
        return False if False in found else None if None in found else True
    mine = SCREEN.get(text)
    return None if mine is None else mine not in (0.0, "none", "no-preference")


def _condition(text: str, feature: Callable[[str], bool | None]) -> bool | None:
    names = {True: " true ", False: " false ", None: " unknown "}

    def inner(m: re.Match) -> str:
        words = m[1].split()
        evaluated = {"true", "false", "unknown"} & {*words}
        return names[_joined(words) if evaluated else feature(m[1])]

    for _ in range(20):
        text, n = _INNER.subn(inner, text)
        if not n:
            return _joined(text.split())
    return None


def on_screen(media: str) -> bool:
    """Whether a list of media queries holds for the screen; an empty one does."""
    media = media.lower()
    return not media.strip() or any(_condition(q, _feature) is True for q in media.split(","))


def _holds(rule: str) -> bool:
    """Whether the rules inside the block of an at-rule count."""
    name, rest = re.fullmatch(r"@([\w-]*)(.*)", rule, re.S).groups()
    name = name.lower()
    if name == "supports":
        # Current browsers support what pages ask for.
        return _condition(re.sub(r"[\w-]+\(", " (", rest.lower()), lambda _: True) is True
    return name == "layer" or name == "media" and on_screen(rest)


def declared(body: list[str]) -> dict[str, tuple[int, str]]:
    """``display`` ("none", "shown" or "default") and ``visibility`` of declarations, each with its importance."""
    found: dict[str, tuple[int, str]] = {}
    for text in body:
        name, colon, value = text.partition(":")
        name = name.strip().lower()
        if not colon or name not in ("display", "visibility"):
            continue
        value, important = re.subn(r"\s*!\s*important\s*$", "", value.lower())
        value = " ".join(value.split())
        if name == "visibility":
            value = _VISIBILITY.get(value, "")
        elif value in ("revert", "revert-layer"):
            value = "default"
        elif value and all(map(_DISPLAY.fullmatch, value.split(" "))):
            value = "none" if value == "none" else "shown"
        else:
            value = ""
        if value and (name not in found or important >= found[name][0]):
            found[name] = (important, value)
    return found


def own_style(text: str) -> Said:
    """What an element's ``style`` attribute says."""
    found = declared(_IGNORED.sub(lambda m: " " if m[0][0] == "/" else "", text).split(";"))
    return {name: ((important, 1), value) for name, (important, value) in found.items()}


def _plain(name: str) -> str:
    def one(m: re.Match) -> str:
        code = int(m[1], 16) if m[1] else 0
        return m[2] if m[2] else chr(code) if 0 < code < 0x110000 else "\ufffd"

    return re.sub(r"\\(?:([0-9a-fA-F]{1,6})\s?|(.))", one, name, flags=re.S) if "\\" in name else name


class Sheets:
    """The rules of a page's style sheets, found by what their selectors ask for."""

    def __init__(self, sheets: list[str]):
        self.rules: dict[str, dict[tuple, Said]] = {}
        self.seen: dict[tuple, Said] = {}
        self.order = 0
        for sheet in sheets:
            self.read(_IGNORED.sub(lambda m: " " if m[0][:1] in "/<-" else '""', sheet))

    def read(self, css: str) -> None:
        # What is open: a block of rules, of declarations for a selector, or one that does not count.
        blocks: list[tuple[str, str, list[str], bool]] = [("rules", "", [], False)]
        at = 0

        def closed() -> None:
            kind, selectors, body, layered = blocks.pop()
            if kind == "style":
                self.rule(selectors, declared(body), layered)

        for m in re.finditer(r"[{};]", css):
            kind, selectors, body, layered = blocks[-1]
            text = css[at : m.start()].strip()
            if m[0] == ";" and kind == "rules" and not text.startswith("@"):
                continue
            at = m.end()
            if m[0] == "{":
                if kind == "skip" or (text.startswith("@") and not _holds(text)):
                    blocks.append(("skip", "", [], False))
                elif text.startswith("@"):
                    blocks.append((kind, selectors, [], layered or text[:6].lower() == "@layer"))
                else:
                    blocks.append(("style" if kind == "rules" else "skip", text, [], layered))
                continue
            if kind == "style":
                body.append(text)
            if m[0] == "}" and len(blocks) > 1:
                closed()
        blocks[-1][2].append(css[at:])
        while len(blocks) > 1:
            closed()

    def rule(self, selectors: str, said: dict[str, tuple[int, str]], layered: bool) -> None:
        self.order += 1
        if not said:
            return
        n = 1
        while n:
            selectors, n = _INNER.subn("<>", selectors)
        for selector in selectors.split(","):
            m = _COMPOUND.fullmatch(selector.strip())
            if not m or not m[0]:
                continue
            tag = "" if m[1] in (None, "*") else _plain(m[1]).lower()
            parts = _PART.findall(m[2])
            ids, classes = ({_plain(x) for mark, x, _ in parts if mark == sign} for sign in "#.")
            having = {x.lower() for _, _, x in parts if x}
            key = f"#{min(ids)}" if ids else f".{min(classes)}" if classes else tag or "*"
            weight = [sum(p[0] == "#" for p in parts), sum(p[0] != "#" for p in parts), bool(tag)]
            known = self.rules.setdefault(key, {}).setdefault((tag, *map(frozenset, (ids, classes, having))), {})
            for name, (important, value) in said.items():
                rank = (important, 0, layered == bool(important), *weight, self.order)
                if name not in known or rank >= known[name][0]:
                    known[name] = (rank, value)

    def of(self, tag: str, attributes: dict[str, str]) -> Said:
        """What holds for an element by the sheets alone."""
        names = tuple(attributes.get("class", "").split())
        kind = (tag, attributes.get("id"), names, frozenset(attributes))
        if kind not in self.seen:
            found: Said = {}
            for key in {tag, "*", f"#{kind[1]}", *(f".{c}" for c in names)}:
                for (name, ids, classes, having), said in self.rules.get(key, {}).items():
                    if name in ("", tag) and ids <= {kind[1]} and classes <= {*names} and having <= kind[3]:
                        for x, ranked in said.items():
                            found[x] = max(found.get(x, ranked), ranked)
            self.seen[kind] = found
        return self.seen[kind]
