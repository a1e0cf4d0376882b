"""One HTML page to its text blocks: a tag stack over the standard library tokenizer."""

from __future__ import annotations

import html.entities
import re
from html.parser import HTMLParser

# Elements whose whole subtree is left out.
REMOVED = frozenset(("script", "style", "header", "footer", "form"))
# Elements that become blocks.
KEPT = frozenset(("title", "h1", "h2", "h3", "h4", "h5", "h6", "div", "p", "img"))
# Elements that hold text of their own kind, invisible to others.
OWN_TEXT_KIND = frozenset(("rt", "rp", "style", "script", "template"))
# Elements that keep white space as it is.
PREFORMATTED = frozenset(("pre", "textarea"))
COUNTED = REMOVED | OWN_TEXT_KIND | PREFORMATTED
# Elements without content, of HTML 5 and of earlier versions.
VOID = frozenset(
    (
        "area", "base", "br", "col", "embed", "hr", "img", "input", "keygen", "link",
        "menuitem", "meta", "param", "source", "track", "wbr",
        "basefont", "bgsound", "command", "frame", "image", "isindex", "nextid", "spacer",
    )
)
_ASCII_SPACE = re.compile(r"[ \n\t\f\r]*\Z")


class _Open:
    """An open element on the stack."""

    __slots__ = ("name", "ordinal", "parent", "block", "children")

    def __init__(self, name, ordinal, parent):
        self.name, self.ordinal, self.parent = name, ordinal, parent
        self.block = self.children = None

    def xpath(self):
        steps, at = [], self
        while at.parent is not None:
            steps.append(f"/{at.name}[{at.ordinal}]")
            at = at.parent
        return "".join(reversed(steps))


class _Block:
    __slots__ = ("tag", "start", "end", "direct", "own", "src", "alt", "element", "in_nav")

    def __init__(self, tag, start, element, in_nav):
        self.tag, self.start, self.element, self.in_nav = tag, start, element, in_nav
        self.end = None
        self.direct, self.own = [], []
        self.src = self.alt = None


class PageBlocks(HTMLParser):
    """Collects the blocks of one page in document order.

    An end tag closes up to its match and is ignored without one; nothing closes
    implicitly, so an unclosed ``<p>`` holds the ones after it.
    """

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.stack = [_Open("", 0, None)]
        self.open_blocks = []
        self.open_names = {}
        self.removed = self.own_kind = self.preformatted = 0
        self.self_closed = {}
        self.blocks = []
        self.strings = []
        self.pending = []

    def updatepos(self, i, j):
        # Line numbers are not asked for.
        return j

    def _flush(self):
        if self.pending:
            data = "".join(self.pending)
            self.pending.clear()
            self._text(data, visible=not self.own_kind)

    def _text(self, data, visible):
        if self.removed:
            return
        if not self.preformatted and _ASCII_SPACE.match(data):
            data = "\n" if "\n" in data else " "
        parent = self.stack[-1].block
        if parent is not None and parent.tag == "div":
            parent.direct.append(data)
        if visible:
            stripped = data.strip()
            if stripped:
                self.strings.append(stripped)
            if self.open_blocks:
                self.open_blocks[-1].own.append(data)

    def handle_starttag(self, tag, attrs):
        self._open(tag, attrs)
        if tag in VOID:
            self._close(tag)
            self.self_closed[tag] = self.self_closed.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self._open(tag, attrs)
        self.handle_endtag(tag)

    def _open(self, tag, attrs):
        self._flush()
        parent = self.stack[-1]
        if parent.children is None:
            parent.children = {}
        ordinal = parent.children[tag] = parent.children.get(tag, 0) + 1
        element = _Open(tag, ordinal, parent)
        self.stack.append(element)
        if tag in KEPT and not self.removed:
            block = _Block(tag, len(self.strings), element, bool(self.open_names.get("nav")))
            if tag == "img":
                values = dict(attrs)
                block.src = values.get("src") or ""
                block.alt = values.get("alt") or ""
            element.block = block
            self.blocks.append(block)
            self.open_blocks.append(block)
        self._count(tag, 1)

    def _count(self, tag, step):
        self.open_names[tag] = self.open_names.get(tag, 0) + step
        if tag in COUNTED:
            self.removed += step * (tag in REMOVED)
            self.own_kind += step * (tag in OWN_TEXT_KIND)
            self.preformatted += step * (tag in PREFORMATTED)

    def handle_endtag(self, tag):
        if self.self_closed.get(tag):
            self.self_closed[tag] -= 1
        else:
            self._close(tag)

    def _close(self, tag):
        self._flush()
        while self.open_names.get(tag):
            if self._pop() == tag:
                break

    def _pop(self):
        element = self.stack.pop()
        self._count(element.name, -1)
        if element.block is not None:
            element.block.end = len(self.strings)
            self.open_blocks.pop()
        return element.name

    def handle_data(self, data):
        self.pending.append(data)

    def handle_charref(self, name):
        text = ""
        try:
            number = int(name[1:], 16) if name[0] in "xX" else int(name)
            if number < 256:
                # Numbers below 256 mean Windows-1252 where that has a character.
                text = bytes((number,)).decode("windows-1252", "ignore")
            text = text or chr(number)
            text.encode()
        except (ValueError, OverflowError):
            text = "\N{REPLACEMENT CHARACTER}"
        self.pending.append(text)

    def handle_entityref(self, name):
        known = html.entities.html5
        self.pending.append(known.get(name + ";") or known.get(name) or "&" + name)

    def _hidden(self, data):
        self._flush()
        self._text(data, visible=False)

    handle_comment = handle_pi = _hidden

    def handle_decl(self, decl):
        self._hidden(decl[len("DOCTYPE ") :])

    def unknown_decl(self, data):
        if data.upper().startswith("CDATA["):
            self._flush()
            self._text(data[len("CDATA[") :], visible=True)
        else:
            self._hidden(data)

    def finish(self):
        self._flush()
        while len(self.stack) > 1:
            self._pop()

    def rows(self, with_text=True, least_own=0):
        """(tag, text, own_text, src, alt, xpath, in_nav) per block.

        ``text`` follows the rendering rules: stripped strings of the subtree joined
        without a space, or the direct text of a ``div``; a ``div`` without any is left
        out. ``own_text`` is the text that no deeper block holds, white space collapsed.
        A block with less than ``least_own`` characters of it gets no ``xpath``.
        """
        for b in self.blocks:
            text = None
            if b.tag == "div":
                text = "".join(b.direct).strip()
                if not text:
                    continue
            elif b.tag != "img" and with_text:
                text = "".join(self.strings[b.start : b.end])
            own = " ".join("".join(b.own).split())
            xpath = b.element.xpath() if len(own) >= least_own else None
            yield b.tag, text if with_text else None, own, b.src, b.alt, xpath, b.in_nav


def page_blocks(page: str, with_text: bool = True, least_own: int = 0):
    """``(rows, error)``: markup the tokenizer rejects gives no rows and its message."""
    parser = PageBlocks()
    try:
        parser.feed(page)
        parser.close()
        parser.finish()
    except AssertionError as problem:
        return [], str(problem) or "rejected markup"
    return list(parser.rows(with_text, least_own)), None
