"""Configurations of books and review files: the part of YAML that they use."""

from __future__ import annotations

import re
from collections.abc import Iterator


def _without_comment(line: str) -> str:
    """A line up to the # that begins a comment: at its start or behind a blank, outside quotes."""
    quote = ""
    for i, c in enumerate(line):
        if quote:
            quote = "" if c == quote else quote
        elif c in "\"'" and (i == 0 or line[i - 1] in " [{,:"):
            quote = c
        elif c == "#" and (i == 0 or line[i - 1] == " "):
            return line[:i]
    return line


def _parts(s: str) -> Iterator[str]:
    """What commas separate outside quotes and brackets."""
    depth, quote, start = 0, "", 0
    for i, c in enumerate(s):
        if quote:
            quote = "" if c == quote else quote
        elif c in "\"'":
            quote = c
        elif c in "[{":
            depth += 1
        elif c in "]}":
            depth -= 1
        elif c == "," and depth == 0:
            yield s[start:i]
            start = i + 1
    if s[start:].strip():
        yield s[start:]


def _pair(s: str) -> tuple[str, str] | None:
    m = re.match(r"""\s*("[^"]*"|'[^']*'|[^\s\[{"'].*?)\s*:(?:\s+(.*))?$""", s, re.S)
    return (str(_scalar(m[1])) if m[1][0] in "\"'" else m[1], (m[2] or "").strip()) if m else None


def _scalar(s: str):
    s = s.strip()
    if s[:1] == "{" and s[-1:] == "}":
        return dict((k, _scalar(v)) for k, v in (_pair(p) for p in _parts(s[1:-1])))
    if s[:1] == "[" and s[-1:] == "]":
        return [_scalar(p) for p in _parts(s[1:-1])]
    if len(s) > 1 and s[0] == s[-1] == "'":
        return s[1:-1].replace("''", "'")
    if len(s) > 1 and s[0] == s[-1] == '"':
        return re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), s[1:-1])
    if re.fullmatch(r"-?[0-9]+", s):
        return int(s)
    if re.fullmatch(r"-?[0-9]+\.[0-9]*", s):
        return float(s)
    return {"": None, "null": None, "~": None, "true": True, "false": False}.get(s, s)


def parse(text: str):
    """Nested mappings and lists by indentation, inline {} and [], quoted and plain scalars that may run over lines, numbers, comments."""
    lines = [(len(x) - len(x.lstrip()), x.strip()) for x in map(_without_comment, text.replace("\t", "    ").split("\n")) if x.strip() and x.strip() != "---"]

    def joined(rest: str, i: int, indent: int) -> tuple[str, int]:
        """A value with the deeper lines that it runs on over."""
        while i < len(lines) and lines[i][0] > indent:
            rest = rest[:-1] + lines[i][1].removeprefix("\\") if rest.endswith("\\") else f"{rest} {lines[i][1]}"
            i += 1
        return rest, i

    def block(i: int, indent: int):
        """The value whose lines begin at i with that indent, and the line behind it."""
        if lines[i][1].startswith("- ") or lines[i][1] == "-":
            out = []
            while i < len(lines) and lines[i][0] == indent and lines[i][1][:1] == "-" and lines[i][1][:2] in ("-", "- "):
                rest = lines[i][1][1:].strip()
                if rest and (_pair(rest) is None or rest[0] in "[{\"'"):
                    rest, i = joined(rest, i + 1, indent)
                    out.append(_scalar(rest))
                    continue
                if rest:  # a mapping that begins on the line of its dash
                    lines[i] = (indent + 2, rest)
                else:
                    i += 1
                value, i = block(i, lines[i][0])
                out.append(value)
            return out, i
        out = {}
        while i < len(lines) and lines[i][0] == indent:
            pair = _pair(lines[i][1])
            if pair is None:
                raise ValueError(f"no key and value: {lines[i][1][:80]}")
            key, rest = pair
            i += 1
            if rest:
                rest, i = joined(rest, i, indent)
                out[key] = _scalar(rest)
            elif i < len(lines) and (lines[i][0] > indent or lines[i][0] == indent and lines[i][1][:2] in ("-", "- ")):
                out[key], i = block(i, lines[i][0])
            else:
                out[key] = None
        return out, i

    return block(0, lines[0][0])[0] if lines else {}
