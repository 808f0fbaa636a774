"""Wiki markup to text, in plain Python without Spark: what a document's markup tree would give as prose.

Two passes. The first finds, with one stack, what is bracketed anywhere in the text: comments, tags, templates and
parameters. What gives no text becomes a DROP mark; what gives finished text (a tag's content, a link's display) becomes
a KEEP mark that points to it, so no later rule reads it again. The second goes by lines: headings, lists, preformatted
blocks, dividers, blank lines. Nothing recurses, so depth of nesting costs no Python stack, and every pass is linear.
"""

from __future__ import annotations

import re
from html.entities import name2codepoint

# Fixed values of the markup language (English configuration).
FILE_NAMESPACES = ("file", "image")
CATEGORY_NAMESPACES = ("category",)
EXTENSION_TAGS = frozenset(
    "categorytree ce charinsert chem gallery graph hiero imagemap indicator inputbox mapframe maplink math nowiki poem pre ref references score section source syntaxhighlight templatedata timeline".split()
)
RAW_TAGS = frozenset(("math", "nowiki"))
HTML_TAGS = frozenset(
    "abbr b bdi bdo big blockquote br caption center cite code data dd del dfn div dl dt em font h1 h2 h3 h4 h5 h6 hr i ins kbd li link mark meta ol p q rb rp rt rtc ruby s samp small span strike strong sub sup table td th time tr tt u ul var wbr".split()
)
MAGIC_WORDS = frozenset(
    "disambig expectunusedcategory forcetoc hiddencat index newsectionlink nocc nocontentconvert noeditsection nogallery noindex nonewsectionlink notc notitleconvert notoc staticredirect toc".split()
)
PROTOCOLS = "bitcoin: ftp:// ftps:// geo: git:// gopher:// http:// https:// irc:// ircs:// magnet: mailto: mms:// news: nntp:// redis:// sftp:// sip: sips: sms: ssh:// svn:// tel: telnet:// urn: worldwind:// xmpp: //".split()
DROPPED_DISPLAYS = ("Файл:", "File:")
#: White space as trimmed: the Unicode property, without U+001C to U+001F that str.strip() would take too.
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"

_TOKEN = re.compile(r"<!--|<(/?)([A-Za-z][A-Za-z0-9]*)((?=[\s/>])[^<>]*|)>|\{{2,}|\}{2,}|&(#[0-9]+|#[xX][0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);|__([A-Za-z]+?)__")
_BRACKETS = re.compile(r"\[\[|\]\]")
_TABLE = re.compile(r"^[ \t]*(?:(\{\|)|(\|\}))", re.M)
_OUTER = re.compile(rf"\[({'|'.join(map(re.escape, PROTOCOLS))})([^\s\[\]<>]*)(?:[ \t]+([^\]\n]*))?\]", re.I)
_QUOTES = re.compile(r"'{2,}")
_HEADING = re.compile(r"(={1,6})(.+)\1[ \t]*$", re.S)
_REDIRECT = re.compile(r"\s*#redirect[ \t]*:?[ \t\n]*\[\[[^\[\]\n]*\]\]", re.I)
_PLAIN = re.compile(r"[\[\]{}<&=\r]|''|__|(?:\A|\n)[ \t*#:;-]")
_BLANK = re.compile(r"\n(?:[ \t]*\n)+")


def _quotes(text: str, drop: str) -> str:
    """Text without its runs of apostrophes that turn italic or bold on and off; each line is balanced by itself.

    Two turn italic, three bold, five both; four are an apostrophe and three, more than five are apostrophes and five. Where
    a line has an odd number of italic and of bold turns, one bold turn was an apostrophe and an italic one: the first that
    follows a word of one letter, else the first that follows a longer word, else the first that follows a blank.
    """
    if "''" not in text:
        return text
    return "\n".join(_line_quotes(line, drop) if "''" in line else line for line in text.split("\n"))


def _line_quotes(line: str, drop: str) -> str:
    texts, runs, at = [], [], 0
    for m in _QUOTES.finditer(line):
        n = len(m[0])
        run = 3 if n == 4 else min(n, 5)
        texts.append(line[at : m.start()] + "'" * (n - run))
        runs.append(run)
        at = m.end()
    rest = line[at:]
    both = runs.count(5)
    if (runs.count(2) + both) % 2 and (runs.count(3) + both) % 2:
        found: dict[str, int] = {}
        for i, run in enumerate(runs):
            if run == 3:
                last = texts[i].replace(drop, "")[-2:]
                kind = "blank" if last.endswith(" ") else "letter" if len(last) == 2 and last[0] == " " else "word"
                found.setdefault(kind, i)
        i = found.get("letter", found.get("word", found.get("blank")))
        if i is not None:
            texts[i] += "'"
    return "".join(texts) + rest


def _entity(name: str) -> bool:
    if name[0] != "#":
        return name in name2codepoint
    digits = name[1:].lstrip("0") if name[1] not in "xX" else name[2:].lstrip("0")
    if len(digits) > 8 or not digits:
        return False
    code = int(digits, 16 if name[1] in "xX" else 10)
    return 0 < code < 0x110000 and not 0xD800 <= code < 0xE000


class OutOfSteps(Exception):
    """A text took more steps than it may: markup tokens, brackets of links and lines, so the same ones on every machine."""


class _Document:
    def __init__(self, text: str, skip_lists: bool, steps: int | None = None):
        self.skip_lists = skip_lists
        self.left = -1 if steps is None else steps
        marks = (chr(c) for c in range(0xF0000, 0xF0000 + len(text) + 3) if chr(c) not in text)
        self.drop, self.keep = next(marks), next(marks)
        self.kept: list[str] = []
        self._pointer = re.compile(f"{self.keep}([0-9]+){self.keep}")

    def step(self) -> None:
        if self.left == 0:
            raise OutOfSteps
        self.left -= 1

    def hold(self, text: str) -> str:
        if not text:
            return self.drop
        self.kept.append(text)
        return f"{self.keep}{len(self.kept) - 1}{self.keep}"

    def release(self, text: str) -> str:
        """Finished text: marks removed and pointed-to text in place. What is held never holds pointers itself."""
        if self.keep in text:
            text = self._pointer.sub(lambda m: self.kept[int(m[1])], text)
        return text.replace(self.drop, "")

    # brackets over the whole text

    def brackets(self, text: str) -> str:
        """Comments, tags, templates, parameters, entities and magic words."""
        frames: list[tuple[str, str, list[str]]] = []  # kind, opener, what came since
        out: list[str] = []
        at = 0
        while True:
            m = _TOKEN.search(text, at)
            if m is None:
                break
            self.step()
            out.append(text[at : m.start()])
            at, token = m.end(), m[0]
            if token == "<!--":
                end = text.find("-->", at)
                at = len(text) if end < 0 else end + 3
                out.append(self.drop)
            elif m[2]:
                name = m[2].lower()
                if name in HTML_TAGS:
                    out.append(self.drop)
                elif name not in EXTENSION_TAGS:
                    out.append(token)
                elif m[1]:
                    place = next((i for i in reversed(range(len(frames))) if frames[i][0] == name), None)
                    if place is None:
                        out.append(self.drop)
                    else:
                        while len(frames) > place + 1:
                            _, opener, before = frames.pop()
                            before += [opener, *out]
                            out = before
                        _, _, before = frames.pop()
                        before.append(self.drop if name == "ref" else self.hold(self.blocks("".join(out))))
                        out = before
                elif m[3].endswith("/"):
                    out.append(self.drop)
                elif name in RAW_TAGS:
                    end = re.compile(f"</{name}\\s*>", re.I).search(text, at)
                    if end is None:
                        out.append(token)
                    else:
                        out.append(self.hold(text[at : end.start()].strip(SPACE)))
                        at = end.end()
                else:
                    frames.append((name, token, out))
                    out = []
            elif token[0] == "{":
                frames.append(("{", token, out))
                out = []
            elif token[0] == "}":
                left = len(token)
                while left >= 2 and frames and frames[-1][0] == "{":
                    _, opener, before = frames.pop()
                    n = min(left, len(opener), 3)
                    left -= n
                    rest = opener[n:]
                    if len(rest) >= 2:
                        frames.append(("{", rest, before))
                        out = [self.drop]
                    else:
                        before += [rest, self.drop]
                        out = before
                out.append("}" * left)
            elif m[4]:
                out.append(self.drop if _entity(m[4]) else token)
            else:
                out.append(self.drop if m[5].lower() in MAGIC_WORDS else token)
        out.append(text[at:])
        while frames:  # what stays open is text
            _, opener, before = frames.pop()
            before += [opener, *out]
            out = before
        return "".join(out)

    def tables(self, text: str) -> str:
        if "{|" not in text:
            return text
        opened: list[int] = []
        spans: list[tuple[int, int]] = []
        for m in _TABLE.finditer(text):
            if m[1]:
                opened.append(m.start(1))
            elif opened:
                start = opened.pop()
                while spans and spans[-1][0] > start:
                    spans.pop()
                spans.append((start, m.end()))
        for start, end in reversed(spans):
            text = text[:start] + self.drop + text[end:]
        return text

    def links(self, text: str) -> str:
        if "[[" not in text:
            return text
        frames: list[list[str]] = []
        out: list[str] = []
        at = 0
        for m in _BRACKETS.finditer(text):
            self.step()
            out.append(text[at : m.start()])
            at = m.end()
            if m[0] == "[[":
                frames.append(out)
                out = []
            elif frames:
                inner, out = "".join(out), frames.pop()
                out.append(self.link(inner))
            else:
                out.append("]]")
        out.append(text[at:])
        while frames:
            out = [*frames.pop(), "[[", *out]
        return "".join(out)

    def link(self, inner: str) -> str:
        target, pipe, display = inner.partition("|")
        if not target.strip() or any(c in target for c in ("\n", "[", "]", "{", "}", "<", ">", self.drop, self.keep)):
            return f"[[{inner}]]"
        namespace = target.partition(":")[0].strip().lower() if ":" in target else ""
        if namespace in FILE_NAMESPACES or namespace in CATEGORY_NAMESPACES:
            return self.drop
        shown = self.paragraphs(display if pipe else target)
        return self.drop if any(d in shown for d in DROPPED_DISPLAYS) else self.hold(shown)

    def outer(self, m: re.Match) -> str:
        """An external link gives its label, unless that is an address itself."""
        shown = self.paragraphs(m[3] or "")
        return self.drop if shown.startswith(("http://", "https://")) else self.hold(shown)

    def paragraphs(self, text: str) -> str:
        """Finished text of what stands inside a line: outer links, quotes, blank lines."""
        parts = [self.release(_quotes(_OUTER.sub(self.outer, p), self.drop)).strip(SPACE) for p in _BLANK.split(text)]
        return "\n\n".join(p for p in parts if p)

    # lines

    def blocks(self, text: str) -> str:
        """Finished text of a document or of a tag's content."""
        text = _OUTER.sub(self.outer, self.links(self.tables(text)))
        done: list[str] = []
        now: list[str] = []  # the open paragraph
        lines, i = text.split("\n"), 0
        after_text = False
        inline = lambda s: self.release(_quotes(s, self.drop))
        while i < len(lines):
            line = lines[i]
            i += 1
            self.step()
            if not line.strip(" \t"):
                if i < len(lines) or i == 1:  # a last empty line ends no paragraph
                    shown = "".join(now).strip(SPACE)
                    if shown:
                        done.append(shown)
                        now = []
                after_text = False
                continue
            kind = line[0]
            if kind == "=" and (m := _HEADING.match(line.replace(self.drop, ""))):
                shown = inline(m[2]).strip(SPACE)
                if shown:
                    before = "".join(now)
                    if before:
                        done.append(before)
                        now = []
                    done.append(shown)
                after_text = False
                continue
            if kind in "*#:;":
                items = [line]
                while i < len(lines) and lines[i][:1] and lines[i][0] in "*#:;":
                    self.step()
                    items.append(lines[i])
                    i += 1
                if not self.skip_lists:
                    now.append(self.items(items, inline))
                after_text = False
                continue
            if kind == " ":
                own = [line[1:]]
                while i < len(lines) and lines[i][:1] == " " and lines[i].strip(" \t"):
                    self.step()
                    own.append(lines[i][1:])
                    i += 1
                now.append(inline("\n".join(own)).strip(SPACE))
                after_text = False
                continue
            if line.startswith("----"):
                line = line.lstrip("-")
                if not line.strip(" \t"):
                    after_text = False
                    continue
                after_text = False
            if after_text:
                now.append("\n")
            now.append(inline(line))
            after_text = True
        last = "".join(now).strip(SPACE)
        if last:
            done.append(last)
        return "\n\n".join(done)

    @staticmethod
    def items(lines: list[str], inline) -> str:
        """Items trimmed and each followed by a space; an item's own list follows its text directly, as trees of items give it."""
        stack: list[tuple[str, list[str]]] = []  # prefix and text of the open items, outermost first
        out: list[str] = []

        def close(depth: int) -> None:
            while len(stack) > depth:
                shown = "".join(stack.pop()[1]).strip(SPACE)
                if shown:
                    (stack[-1][1] if stack else out).append(shown + " ")

        for line in lines:
            text = line.lstrip("*#:;")
            prefix = line[: len(line) - len(text)].replace(";", ":")
            shared = 0
            while shared < min(len(stack), len(prefix)) and stack[shared][0] == prefix[shared]:
                shared += 1
            close(min(shared, len(prefix) - 1))
            while len(stack) < len(prefix):
                stack.append((prefix[len(stack)], []))
            stack[-1][1].append(inline(text))
        close(0)
        return "".join(out)


def extract(text: str, skip_lists: bool = False, steps: int | None = None) -> str:
    """Text of a whole document's markup: paragraphs trimmed and parted by an empty line. OutOfSteps where `steps` are given and don't suffice; text without markup takes none."""
    if not _PLAIN.search(text):
        return "\n\n".join(p for p in (x.strip(SPACE) for x in _BLANK.split(text)) if p)
    m = _REDIRECT.match(text)
    if m:
        text = text[m.end() :]
    doc = _Document(text, skip_lists, steps)
    return doc.blocks(doc.brackets(text))
