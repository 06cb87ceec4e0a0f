"""Reading raw e-mails: parts, decoded text, and what the author wrote.

Written for speed on executors: regular expressions over the raw text, and
only text parts are decoded. Nothing raises on broken input: unclosed
multiparts end with the message, undecodable bytes become U+FFFD, text
without headers is one plain part. Multiparts and attached messages may be
nested to any depth; attached messages are read like the outer one, also where
they are encoded as a whole.
"""

from __future__ import annotations

import binascii
import html
import quopri
import re
from typing import NamedTuple

_END_OF_HEADERS = re.compile(r"\r?\n[ \t]*(?:\r\n|\n|\r)|\r[ \t]*\r")
_FIELD = re.compile(r"^(content-type|content-transfer-encoding|content-disposition)[ \t]*:((?:[^\r\n]|\r?\n[ \t]+)*)", re.I | re.M)
_HEADER_START = re.compile(r"(?:>?From [^\n]*\n)?[!-9;-~]+[ \t]*:")
_BOUNDARY = re.compile(r'boundary[ \t]*=[ \t]*(?:"([^"]*)"|([^\s;]+))', re.I)
_CHARSET = re.compile(r'charset[ \t]*=[ \t]*"?([\w.:-]+)', re.I)
_NOT_B64 = re.compile(r"[^A-Za-z0-9+/]+")


class Part(NamedTuple):
    kind: str  # lower-case media type
    charset: str
    encoding: str
    attached: bool
    start: int  # of the body in the raw text
    end: int


def parts(raw: str) -> list[Part]:
    """Leaf parts of a message, in order; an encoded attached message is one leaf."""
    out, todo = [], [(0, len(raw), True)]
    while todo:
        start, end, message = todo.pop()
        fields, body = {}, start
        if not message or _HEADER_START.match(raw, start, end):
            if message or raw[start : start + 1] not in ("\n", "\r"):  # else a section without headers
                m = _END_OF_HEADERS.search(raw, start, end)
                stop, body = (m.start(), m.end()) if m else (end, end)
                fields = {f[1].lower(): f[2].strip() for f in _FIELD.finditer(raw, start, stop)}
        declared = fields.get("content-type", "")
        kind = declared.split(";", 1)[0].strip().lower() or "text/plain"
        encoding = fields.get("content-transfer-encoding", "").lower()
        if kind == "message/rfc822" and encoding not in ("base64", "quoted-printable"):
            todo.append((body, end, True))
            continue
        b = _BOUNDARY.search(declared) if kind.startswith("multipart/") else None
        if b:
            mark = re.compile(r"^--" + re.escape(b[1] or b[2]) + r"(--)?[ \t]*(?:\r\n|\n|\r|\Z)", re.M)
            sections, at = [], None
            for m in mark.finditer(raw, body, end):
                if at is not None:
                    sections.append((at, m.start(), False))
                at = None if m[1] else m.end()
                if m[1]:
                    break
            if at is not None:  # never closed
                sections.append((at, end, False))
            todo += reversed(sections)
            continue
        c = _CHARSET.search(declared)
        out.append(Part("text/plain" if kind.startswith("multipart/") else kind, c[1].lower() if c else "utf-8", encoding, fields.get("content-disposition", "").lower().startswith("attachment"), body, end))
    return out


def decoded(raw: str, part: Part) -> str:
    """Text of one leaf part."""
    body = raw[part.start : part.end]
    if part.encoding == "base64":
        packed = _NOT_B64.sub("", body)
        data = binascii.a2b_base64(packed[: len(packed) // 4 * 4] + (packed[-(len(packed) % 4) :] + "=" * (4 - len(packed) % 4) if len(packed) % 4 > 1 else ""))
    elif part.encoding == "quoted-printable":
        data = quopri.decodestring(body.encode("utf-8", "surrogatepass"))
    else:
        return body
    try:
        return data.decode(part.charset, "replace")
    except LookupError:
        return data.decode("utf-8", "replace")


def original_offset(raw: str, part: Part, offset: int) -> int:
    """Place in the raw message of a character offset in the decoded part."""
    if part.encoding not in ("base64", "quoted-printable"):
        return part.start + offset
    n = len(decoded(raw, part)[:offset].encode(part.charset if part.charset != "us-ascii" else "utf-8", "replace"))
    at, body = 0, raw[part.start : part.end]
    if part.encoding == "base64":
        want = n * 4 // 3
        for i, ch in enumerate(body):
            if not _NOT_B64.match(ch):
                if at >= want:
                    return part.start + i
                at += 1
        return part.end
    i = 0
    while i < len(body) and at < n:
        soft = re.match(r"=[ \t]*\r?\n", body[i : i + 8])
        if soft:
            i += soft.end()
        elif re.match(r"=[0-9A-Fa-f]{2}", body[i : i + 3]):
            i, at = i + 3, at + 1
        else:
            at, i = at + len(body[i].encode("utf-8", "replace")), i + 1
    return part.start + i


_HIDDEN = re.compile(r"<!--.*?-->|<(style|script|head)\b.*?</\1\s*>", re.I | re.S)
_BLOCK = re.compile(r"<(?:br|/?p|/?div|/?tr|/?li|/?h\d|/?ul|/?table|hr)\b[^>]*>", re.I)
_QUOTE_TAG = re.compile(r"<(/?)blockquote\b[^>]*>", re.I)
_TAG = re.compile(r"<[^>]*>")
_ENTITY = re.compile(r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)")


def without_quotes(markup: str) -> str:
    """HTML less its blockquotes, nested ones included; what stands between them stays."""
    out, depth, at = [], 0, 0
    for m in _QUOTE_TAG.finditer(markup):
        if m[1]:
            if depth:
                depth -= 1
                at = m.end()
        else:
            if not depth:
                out.append(markup[at : m.start()])
            depth += 1
    if not depth:
        out.append(markup[at:])
    return "\n".join(out)


def html_text(markup: str, quotes: bool = True) -> str:
    """Text of HTML; block tags become line ends, inline tags nothing."""
    if "<!--" in markup or "<style" in markup or "<script" in markup or "<head" in markup:
        markup = _HIDDEN.sub(" ", markup)
    if not quotes:
        markup = without_quotes(markup)
    return html.unescape(_TAG.sub("", _BLOCK.sub("\n", markup)))


def html_places(markup: str) -> list[int]:
    """For each character of ``html_text(markup)``, its place in the markup."""
    text, at = markup, list(range(len(markup)))

    def put(pattern: re.Pattern, becomes) -> None:
        nonlocal text, at
        pieces, places, done = [], [], 0
        for m in pattern.finditer(text):
            new = becomes(m[0])
            pieces += [text[done : m.start()], new]
            places += at[done : m.start()] + [at[m.start()]] * len(new)
            done = m.end()
        text, at = "".join([*pieces, text[done:]]), places + at[done:]

    if "<!--" in markup or "<style" in markup or "<script" in markup or "<head" in markup:
        put(_HIDDEN, lambda _: " ")
    put(_BLOCK, lambda _: "\n")
    put(_TAG, lambda _: "")
    put(_ENTITY, html.unescape)
    return at


class Text(NamedTuple):
    """Readable text of one part of a message."""

    part: Part
    text: str
    source: str  # the message the part lies in: the outer one, or an attached one after decoding
    markup: bool
    outer: tuple | None  # (message, part) of the encoded attached messages around it, innermost first

    def origin(self, first: int, last: int) -> tuple[int, int]:
        """Range in the outermost message that holds the characters ``first`` to ``last`` of the text."""
        if self.markup:
            at = html_places(decoded(self.source, self.part))
            first, last = at[first], at[last]
        start, end = original_offset(self.source, self.part, first), original_offset(self.source, self.part, last + 1)
        outer = self.outer
        while outer:
            source, part, outer = outer
            start, end = original_offset(source, part, start), original_offset(source, part, end)
        return start, end


def texts(raw: str) -> list[Text]:
    """All readable text of a message: plain, HTML (as text), attached text and messages."""
    out, todo = [], [(raw, None)]
    while todo:
        source, outer = todo.pop()
        for p in parts(source):
            if p.kind == "message/rfc822":
                inner = decoded(source, p)
                if len(inner) < len(source):
                    todo.append((inner, (source, p, outer)))
            elif p.kind.startswith("text/"):
                t = decoded(source, p)
                markup = p.kind == "text/html" or (p.kind == "text/plain" and t.lstrip()[:6].lower() == "<html>")
                out.append(Text(p, html_text(t) if markup else t, source, markup, outer))
    return out


_SAID = re.compile(r"^[ \t]*(?:On|Am|Le|El|Den|Il|Op)\b.{0,200}?(?:wrote|writes|schrieb|a écrit|escribió)\b[^\n:]{0,120}:[ \t]*$", re.M | re.S)
_FORWARD = re.compile(r"^[ \t]*(?:-{3,}[ \t]*[^\n-]{3,40}?-{3,}|From:[^\n]*\n(?:Sent|Date|To):[^\n]*)[ \t]*$", re.M | re.I)
_FORWARDED_WORDS = re.compile(r"original|forward|urspr|weiter|message|nachricht|mensaje|from:", re.I)
_SIGNATURE = re.compile(r"^-- ?[ \t]*$", re.M)
_RULE = re.compile(r"^(?:-{3,}|_{3,}|\*{3,}|={3,}|[ \t]*(?:disclaimer|confidentiality notice|confidential|legal notice|notice|important)[ \t]*:?)[ \t]*$", re.M | re.I)
_DISCLAIMS = re.compile(r"\b(?:confidential|intended|addressed|recipient|addressee|privileged|liab\w+|disclos\w+|unauthori[sz]ed|scanned|virus\w*|on record|registered office|company no|views|printing|print this|delete|secret|vertraulich\w*|confidentiel\w*|destinataire|destinatario|empfänger)\b", re.I)
_CLOSING = re.compile(
    r"^[ \t]*(?:(?:with |my |many )?(?:kind|best|warm|kindest|warmest)(?: (?:regards|wishes))?|(?:many )?thanks(?: again| in advance)?|thank you|regards|cheers|yours(?: (?:sincerely|faithfully|truly))?|sincerely)[ \t]*[,.!-]?[ \t]*$",
    re.M | re.I,
)
_GAP = re.compile(r"\n[ \t]*\n[ \t]*\n+")
_QUOTED = re.compile(r"^[ \t]*[>|].*(?:\n|\Z)", re.M)
_GREETING = re.compile(r"\A\s*(?:(?:hello|hi|dear|good (?:morning|afternoon|evening|day)|hey)\b[^\n.!?]{0,60}|[^\W\d_]+)[ \t]*[,:!-][ \t]*\n", re.I)


def own_text(raw: str) -> str:
    """What the author wrote: no headers, quotes, greeting, signature, disclaimer or attachments."""
    leaves = [p for p in parts(raw) if not p.attached]
    body = [p for p in leaves if p.kind == "text/plain"] or [p for p in leaves if p.kind == "text/html"][:1]
    own = (_own(decoded(raw, p), p.kind == "text/html") for p in body)
    return "\n\n".join(t for t in own if t)


def _own(text: str, markup: bool) -> str:
    if markup or text.lstrip()[:6].lower() == "<html>":
        text = html_text(text, quotes=False)
    text = text.replace("\r\n", "\n").replace("\r", "\n")
    for m in _FORWARD.finditer(text):
        if _FORWARDED_WORDS.search(m[0]):
            before = text[: m.start()]
            if before.strip():
                text = before
            else:  # the reply stands below the quoted message: after its last quoted line, or two empty lines
                last = None
                for last in _QUOTED.finditer(text, m.end()):
                    pass
                end = last.end() if last else m.end()
                gap = _GAP.search(text, end)
                text = text[gap.end() :] if gap and text[gap.end() :].strip() else text[end:] if last else ""
            break
    if ">" in text or "|" in text:
        text = _QUOTED.sub("", text)
    text = _SAID.sub("", text)
    text = _GREETING.sub("", text, count=1)
    for mark in (_SIGNATURE, _CLOSING):
        m = mark.search(text)
        if m:
            text = text[: m.start()]
    for m in _RULE.finditer(text):  # a rule ends the text only before a disclaimer
        rest = text[m.end() :].strip()
        if not rest or _DISCLAIMS.search(rest.split("\n\n", 1)[0]):
            text = text[: m.start()]
            break
    return text.strip()
