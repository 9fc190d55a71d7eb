"""The rules for nested answers written plainly, by recursion, for tests to compare with."""

from __future__ import annotations

import re

from answerloom.functions.columns import SPACE, SPACES

# Fixed values, as in the column rules.
COMMANDS = ("text", "mathrm", "mathbf")
NUMBER = re.compile(r"[+-]?(?:\d+(?:\.\d*)?|\.\d+)")
TOLERANCE = 1e-9
_REMOVABLE = re.compile(rf"[$\\{SPACE}]")
_WRAPPERS = [re.compile(rf"\\{c}\{{([^}}]*+)\}}|(\\{c}\{{[^}}]*+\Z)") for c in COMMANDS]
_GAPS = re.compile(rf"[{SPACE}]+")
_WORDS = re.compile(r"[A-Za-z]")
_FIGURES = re.compile(r"[\d=+\-*/^]")
_BRACKET = re.compile(r"[(\[{,)\]}]")


def bare(text: str) -> str:
    if not _REMOVABLE.search(text):
        return text
    text = text.strip(SPACES)
    for literal in ("$", "\\left", "\\right"):
        text = text.replace(literal, "")
    for _ in range(3):
        for wrapper in _WRAPPERS:
            text = wrapper.sub(lambda m: m[1] if m[2] is None else m[2], text)
    return _GAPS.sub("", text.replace("\\,", "").replace("\\ ", ""))


def parts(text: str) -> list[str]:
    """Trimmed, non-empty parts between the commas outside any bracket."""
    found, depth, start = [], 0, 0
    for m in _BRACKET.finditer(text):
        if m[0] in "([{":
            depth += 1
        elif m[0] != ",":
            depth = max(0, depth - 1)
        elif not depth:
            found.append(text[start : m.start()])
            start = m.end()
    return [p for p in (x.strip(SPACES) for x in [*found, text[start:]]) if p]


def _core(text: str, left: str, right: str) -> str:
    return text[1:-1] if len(text) > 1 and text[0] == left and text[-1] == right else text


def agree(p: str, g: str) -> bool:
    """The cascade on two bare answers."""
    if p == g:
        return True
    if _WORDS.search(g) and not _FIGURES.search(g):
        return _core(p, "{", "}").lower() == _core(g, "{", "}").lower()
    for left, right in ("()", "{}"):
        if p.startswith(left) and p.endswith(right) and g.startswith(left) and g.endswith(right):
            ours, theirs = ([bare(x) for x in parts(t[1:-1])] for t in (p, g))
            if ours and len(ours) == len(theirs):
                for mine in ours:
                    for at, other in enumerate(theirs[:1] if left == "(" else theirs):
                        if agree(mine, other):
                            del theirs[at]
                            break
                    else:
                        return False
                return True
    if NUMBER.fullmatch(p) and NUMBER.fullmatch(g):
        return abs(float(p) - float(g)) <= TOLERANCE
    if "(" in (p[:1], g[:1]):
        return _core(p, "(", ")") == _core(g, "(", ")")
    return False


def _partners(text: str) -> dict[int, int]:
    """Where each closed brace is closed."""
    found, stack = {}, []
    for m in re.finditer(r"[{}]", text):
        if m[0] == "{":
            stack.append(m.start())
        elif stack:
            found[stack.pop()] = m.start()
    return found


def fractions(text: str) -> str:
    closing, out, done = _partners(text), [], 0
    for m in re.finditer(r"\\d?frac\{", text):
        over = m.end() - 1
        if m.start() < done or over not in closing:
            continue
        under = closing[over] + 1
        if under in closing:
            out += [text[done : m.start()], "((", text[over + 1 : under - 1], "))/((", text[under + 1 : closing[under]], "))"]
            done = closing[under] + 1
    return "".join([*out, text[done:]])


def roots(text: str) -> str:
    closing, edits = _partners(text), {}
    for m in re.finditer(r"\\sqrt\{", text):
        at = m.end() - 1
        if at not in closing:
            break
        edits[m.start()] = (m.end(), "sqrt((")
        edits[closing[at]] = (closing[at] + 1, "))")
    out, done = [], 0
    for start in sorted(edits):
        end, new = edits[start]
        out += [text[done:start], new]
        done = end
    return "".join([*out, text[done:]])
