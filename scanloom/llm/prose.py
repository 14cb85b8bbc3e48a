"""Where the natural language of a source file is: paragraphs, list items, comments and docstrings.

``blocks(text)`` yields (start, text) pieces. A piece has the length of the stretch it covers: comment
signs, list markers and indentation inside it are blanked, so positions in it plus ``start`` are
positions in the file. What a file is gets decided from its content; names and extensions lie.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

# -- lines that are no natural language -------------------------------------------------------------

_NAME = r"[A-Za-z_$][\w$]*"
_PATH = rf"{_NAME}(?:\.{_NAME})*"
#: A line of code or settings. Prose has a blank before "(" and none before "="; code the other way round.
CODE_LINE = re.compile(
    rf"""\s*(?:
      (?:import\ |from\ \S+\ import\b|def\ {_NAME}\(|class\ {_NAME}\s*[:({{]|func\ |fn\ |use\ {_NAME}::|package\ {_NAME}\s*$|\#include\b)
    | (?:const|let|var|static|public|private|protected|final)\ (?:.*[=({{;])
    | (?:function|async)\ .*[({{]
    | (?:BEGIN;|COMMIT;|SELECT\ .*\bFROM\b|INSERT\ INTO\b|UPDATE\ \S+\ SET\b|CREATE\ (?:TABLE|INDEX|VIEW)\b|DELETE\ FROM\b|DROP\ TABLE\b|ALTER\ TABLE\b)
    | (?:set\ -|mkdir\ -|test\ -\w\ |echo\ ["'$-]|exit\ \d|fi\s*$|done\s*$|esac\s*$|export\ {_NAME}=|cd\ [/$])
    | (?:return|raise|throw|yield|await|del|assert)\b\s*(?:;|[^\s;]+\s*[-+*/%<>=&|]+\s*\S+;?\s*$|\S*\(.*\)?;?\s*$|new\ {_NAME}\(|{_NAME};\s*$|["'\d]\S*;?\s*$|None\s*$|True\s*$|False\s*$)
    | (?:if|while|for|elif|switch)\ ?\(.*\)\s*[{{:;]?
    | (?:if|while|elif)\ {_PATH}\ (?:[<>=!]=?|in|is)\ \S+\s*[:{{]
    | {_PATH}(?:\[[^\]]*\])?\s?(?:[-+*/|&^%]|<<|>>|:)?=(?!=)
    | {_PATH}(?:\[[^\]]*\])?\s[-+*/|&^%:]?=\s
    | {_PATH}!?\(.*\)\s*[;{{:]?\s*$
    | {_NAME}:\s\S+\s*$
    | -\ {_PATH}\s*$
    | [\]\)\}}]+[;,]?\s*$
    | </?\w+[^>]*>\s*$
    )""",
    re.VERBOSE,
)
TAG_LINE = re.compile(r"\s*[A-Z][A-Za-z]*(?:-[A-Z][A-Za-z]*)*:[ \t]+\S+\s*$|\s*[A-Z][A-Za-z]*(?:-[A-Z][A-Za-z]*)+:[ \t]")
HEADING = re.compile(r"#{1,6}[ \t]+\S")
ITEM = re.compile(r"[ \t]*(?:[-*+•][ \t]+|\d{1,3}\.[ \t]+)(?=\S)")
LIST_START = re.compile(r"[ \t]*(?:[-*+•]|\d{1,3}\.)[ \t]+\S")
FENCE = re.compile(r"[ \t]*(```|~~~)")
_LINE = re.compile(r"[^\n]*\n?")


def _lines(text: str) -> list[tuple[int, str]]:
    """(start, line without its line end)."""
    out, at = [], 0
    for line in text.split("\n"):
        out.append((at, line[:-1] if line.endswith("\r") else line))
        at += len(line) + 1
    return out


# -- what kind of file ------------------------------------------------------------------------------

_UNFENCED = re.compile(r"(?ms)^[ \t]*(```|~~~).*?(?:^[ \t]*\1[ \t]*\r?$|\Z)")
#: Lines that begin with a comment sign, and, for files without such lines, lines that show the language.
_SIGNS = {
    "slash": re.compile(r"(?m)^[ \t\ufeff]*(?://|/\*)"),
    "hash": re.compile(r"(?m)^[ \t\ufeff]*(?:#(?!include\b|define\b|if\w*\b|endif\b|pragma\b|\[)|\"\"\")"),
    "dash": re.compile(r"(?m)^[ \t\ufeff]*--(?:[ \t]|\r?$)"),
}
_CUES = {
    "slash": re.compile(r"(?m);[ \t]*(?://.*)?\r?$|\{[ \t]*\r?$"),
    "hash": re.compile(r"(?m)^(?:set -eu|def |import \S+\r?$|class \w+:|[\w.]+: \S|  - \S)|\(\) \{[ \t]*\r?$|^[ \t]*(?:test|mkdir) -"),
    "dash": re.compile(r"(?m)^(?:BEGIN;|CREATE TABLE |INSERT INTO |UPDATE \S+ SET |SELECT .* FROM )"),
}

#: A text with more plain lines than so many times its lines of code is prose.
MOST_PLAIN = 3
#: What closes a comment of several lines.
_BLOCK_ENDS = {'"""': '"""', "/*": "*/"}


def _line_counts(body: str) -> tuple[int, int]:
    """(plain, code): how many lines of the whole text are plain, and of code; those of comments are neither."""
    plain = code = 0
    until, unclosed = -1, set()
    for at, line in _lines(body):
        if at < until:
            continue
        line = line.lstrip("\ufeff")
        bare = line.lstrip()
        if not bare:
            continue
        opening = next((x for x in _BLOCK_ENDS if bare.startswith(x)), "")
        if opening and opening not in unclosed:
            closing = _BLOCK_ENDS[opening]
            stop = body.find(closing, body.index(opening, at) + len(opening))
            if stop >= 0:
                until = stop + len(closing)
                continue
            unclosed.add(opening)
        if bare.startswith(("#", "//", "/*", "*", "--")) and not line.startswith("#include"):
            continue
        if CODE_LINE.match(line) and not TAG_LINE.match(line):
            code += 1
        else:
            plain += 1
    return plain, code


def kind_of(text: str) -> str:
    """``prose``, or the comment style of a code file: ``slash``, ``dash`` or ``hash``."""
    body = _UNFENCED.sub("", text) if "```" in text or "~~~" in text else text
    plain, code = _line_counts(body)
    if plain > MOST_PLAIN * code or code == 0:
        if not re.search(r"(?m)^[ \t]*(?://|/\*|--[ \t])", body) or HEADING.match(body.lstrip("﻿")) and not re.search(r"(?m)^[ \t]*(?:/\*)", body):
            return "prose"
    signs = {k: len(r.findall(body)) for k, r in _SIGNS.items()}
    style = max(signs, key=lambda k: signs[k])
    if signs[style]:
        return style
    cues = {k: len(r.findall(body)) for k, r in _CUES.items()}
    return max(cues, key=lambda k: cues[k])


# -- prose files ------------------------------------------------------------------------------------


def _prose(text: str) -> Iterator[tuple[int, str]]:
    start, parts, end = -1, [], 0
    fence, in_list = "", False

    def take(at: int, line: str, skip: int) -> None:
        nonlocal start, end
        if start < 0:
            start = at + skip
            parts.append(line[skip:])
        else:
            parts.append(" " * (at - end + skip) + line[skip:])
        end = at + len(line)

    def flush() -> Iterator[tuple[int, str]]:
        nonlocal start, parts
        if start >= 0:
            yield start, "".join(parts)
        start, parts = -1, []

    for at, line in _lines(text):
        body = line.lstrip(" \t﻿　")
        m = FENCE.match(line)
        if fence:
            if m and m[1] == fence:
                fence = ""
            continue
        if m:
            yield from flush()
            fence, in_list = m[1], False
            continue
        if not body:
            yield from flush()
            in_list = False
            continue
        if HEADING.match(body) or TAG_LINE.match(line):
            yield from flush()
            in_list = False
            continue
        if (start < 0 or in_list) and (m := ITEM.match(line)):
            yield from flush()
            in_list = True
            take(at, line, m.end())
            continue
        take(at, line, len(line) - len(body))
    yield from flush()


# -- code files -------------------------------------------------------------------------------------

_STRING = r"\"(?:\\.|[^\"\\\n])*\"|'(?:\\.|[^'\\\n])*'"
_TOKENS = {
    "slash": re.compile(rf"//(?P<line>[^\n]*)|/\*(?P<block>.*?)\*/|`[^`]*`|{_STRING}", re.DOTALL),
    "hash": re.compile(rf"(?:\A|(?<=[\s;﻿]))#(?P<line>[^\n]*)|\"\"\"(?P<block>.*?)\"\"\"(?!\")|`[^`]*`|{_STRING}", re.DOTALL),
    "dash": re.compile(r"--(?P<line>[^\n]*)|/\*(?P<block>.*?)\*/|'(?:''|[^'\n])*'|\"[^\"\n]*\"|`[^`]*`", re.DOTALL),
}
_BLANKS = " \t\r﻿　"


def _comment_lines(text: str, style: str) -> Iterator[tuple[int, int, bool]]:
    """(start, end, joins): content of comment lines; joins when it may continue the line before."""
    last_line_end, last_alone, last_column = -2, False, -1
    for m in _TOKENS[style].finditer(text):
        if m["line"] is not None:
            head = text.rfind("\n", 0, m.start()) + 1
            alone = not text[head : m.start()].strip(_BLANKS)
            column = m.start() - head - text.startswith("\ufeff", head)
            a, b = m.span("line")
            if text[a:b].startswith(("!", "/", "#", "-")) :
                a += 1
            joins = alone and last_alone and head == last_line_end + 1 and column == last_column
            yield a, b, joins
            last_line_end, last_alone, last_column = m.end(), alone, column
        elif m["block"] is not None:
            a, b = m.span("block")
            if style == "hash":
                head = text.rfind("\n", 0, m.start()) + 1
                if text[head : m.start()].strip(_BLANKS):
                    continue
            elif text[a : a + 1] in "*!":
                a += 1
            first = True
            while a <= b:
                stop = text.find("\n", a, b)
                stop = b if stop < 0 else stop
                s = a
                if not first and style != "hash":
                    while s < stop and text[s] in _BLANKS:
                        s += 1
                    if s < stop and text[s] == "*":
                        s += 1
                yield s, stop, not first
                first, a = False, stop + 1


def _code(text: str, style: str) -> Iterator[tuple[int, str]]:
    start, end, parts = -1, 0, []
    for a, b, joins in _comment_lines(text, style):
        while a < b and text[a] in _BLANKS:
            a += 1
        while b > a and text[b - 1] in _BLANKS:
            b -= 1
        line = text[a:b]
        empty = not line or TAG_LINE.match(line) or CODE_LINE.match(line)
        item = None if empty else LIST_START.match(line) and (start < 0 or not joins) and ITEM.match(line)
        if start >= 0 and (empty or not joins or item):
            yield start, "".join(parts)
            start, parts = -1, []
        if empty:
            continue
        if item:
            a += item.end()
            line = text[a:b]
        if start < 0:
            start = a
        else:
            parts.append(" " * (a - end))
        parts.append(line)
        end = b
    if start >= 0:
        yield start, "".join(parts)


def blocks(text: str | None) -> Iterator[tuple[int, str]]:
    """(start, text) of each stretch of natural language; nothing for NULL or empty text."""
    if not text or text.isspace():
        return
    kind = kind_of(text)
    yield from _prose(text) if kind == "prose" else _code(text, kind)
