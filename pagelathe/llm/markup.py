"""Markup of HTML, Markdown, wikis and LaTeX in text: finding it, and turning it into plain text."""

from __future__ import annotations

import re
from html import unescape

_TAG = r"</?[a-zA-Z][a-zA-Z0-9]*(?:\s+[a-zA-Z:-]+(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>\"']+))?)*\s*/?>"
_ENTITY = r"&(?:[a-zA-Z][a-zA-Z0-9]{1,30}|#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6});"

#: Each kind of markup by a pattern over the visible text of one line.
KINDS: dict[str, re.Pattern] = {
    "html": re.compile(f"{_TAG}|<!--.*?-->|{_ENTITY}"),
    "markdown": re.compile(
        r"\*\*[^\s*](?:[^*]*[^\s*])?\*\*|(?<![\w*])\*[^\s*](?:[^*]*[^\s*])?\*(?![\w*])"
        r"|(?<![\w_])__[^\s_](?:.*?[^\s_])?__(?![\w_])|(?<![\w_])_[^\s_](?:[^_]*[^\s_])?_(?![\w_])"
        r"|~~[^\s~](?:[^~]*[^\s~])?~~|`[^`]+`|```|!?\[[^\[\]]*\]\([^()\s]+(?:\s+\"[^\"]*\")?\)"
        r"|^#{1,6}\s+\S|^>\s|^[*+-]\s+\S|^\|.*\|$|^\[\^?\w+\]:\s"
    ),
    "wiki": re.compile(
        r"\[\[(?:[^\[\]]|\[[^\[\]]*\])+\]\]|\{\{[^{}]*[|:][^{}]*\}\}|'{2,}[^\s'].*?'{2,}|^={2,}\s*\S|\S\s*={2,}$"
        r"|\{\|\s|\|\}|\|-\s|\[https?://\S+ [^\]]+\]"
    ),
    "latex": re.compile(r"\\[a-zA-Z]+\*?\s*(?:\[[^\]]*\])?\{|\\item\b|\\\\(?:\s|$)"),
}
#: A line without any of these signs holds none of them.
SIGNS = re.compile(r"[<&*_~`\[{|'=#>\\+-]")

_FORMULA = re.compile(
    r"\$\$.+\$\$[.,;]?|\$[^$]+\$[.,;]?|\\\(.+\\\)[.,;]?|\\\[.+\\\][.,;]?"
    r"|\\begin\{(equation|align|gather|math|displaymath|eqnarray|multline)\*?\}.*\\end\{\1\*?\}",
    re.S,
)


def is_formula(text: str) -> bool:
    """Whether a line is nothing but a formula."""
    return _FORMULA.fullmatch(text.strip()) is not None


def kinds_in(text: str) -> list[str]:
    """The kinds of markup that a line of visible text holds."""
    if SIGNS.search(text) is None:
        return []
    return [k for k, p in KINDS.items() if p.search(text)]


_STEPS: list[tuple[re.Pattern, str]] = [
    (re.compile(r"<!--.*?-->", re.S), ""),
    (re.compile(r"<ref[^<>]*/>|<ref[^<>]*>.*?</ref>", re.S | re.I), ""),
    (re.compile(r"<br\s*/?>|</?p\b[^<>]*>|</?div\b[^<>]*>", re.I), " "),
    (re.compile(_TAG), ""),
    (re.compile(r"\[\[(?:[A-Za-z]+:)[^\[\]|]*\|(?:[^\[\]]*\|)?((?:[^\[\]|]|\[[^\[\]]*\])*)\]\]"), r"\1"),
    (re.compile(r"\[\[[^\[\]|]*\|([^\[\]]*)\]\]"), r"\1"),
    (re.compile(r"\[\[([^\[\]]*)\]\]"), r"\1"),
    (re.compile(r"\{\{[^{}]*\}\}"), ""),
    (re.compile(r"\{\|[^|]*|\|-|\|\}"), " "),
    (re.compile(r"'{2,}([^\s'].*?)'{2,}"), r"\1"),
    (re.compile(r"^(={2,})\s*(.*?)\s*=*$"), r"\2"),
    (re.compile(r"!\[([^\[\]]*)\]\([^()]*\)"), ""),
    (re.compile(r"\[([^\[\]]*)\]\([^()]*\)"), r"\1"),
    (re.compile(r"\[https?://\S+ ([^\]]+)\]"), r"\1"),
    (re.compile(r"\*\*([^\s*](?:[^*]*[^\s*])?)\*\*"), r"\1"),
    (re.compile(r"(?<![\w*])\*([^\s*](?:[^*]*[^\s*])?)\*(?![\w*])"), r"\1"),
    (re.compile(r"(?<![\w_])__([^\s_](?:.*?[^\s_])?)__(?![\w_])"), r"\1"),
    (re.compile(r"(?<![\w_])_([^\s_](?:[^_]*[^\s_])?)_(?![\w_])"), r"\1"),
    (re.compile(r"~~[^\s~](?:[^~]*[^\s~])?~~"), ""),
    (re.compile(r"`+([^`]+)`+"), r"\1"),
    (re.compile(r"^(?:#{1,6}|>|[*+-])\s+"), ""),
    (re.compile(r"^\|\s*|\s*\|$"), ""),
    (re.compile(r"~?\\(?:cite|footnote|label|ref|index)[a-z]*\*?(?:\[[^\]]*\])?\{[^{}]*\}"), ""),
    (re.compile(r"\\(?:begin|end)\{[^{}]*\}|\\item\b|\\\\(?=\s|$)"), " "),
    (re.compile(r"\\[a-zA-Z]+\*?(?:\[[^\]]*\])?\{([^{}]*)\}"), r"\1"),
]


def plain(text: str) -> str:
    """A line of visible text without markup; entities become the characters they name."""
    for _ in range(3):  # what entities hide may be markup again
        before = text
        for pattern, by in _STEPS:
            text = pattern.sub(by, text)
        text = unescape(text)
        if text == before:
            break
    return " ".join(text.split())
