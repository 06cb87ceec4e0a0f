import base64
import quopri

import pytest

from loomgate.llm import mail

PLAIN = "Hello Ann,\n\nWe saw the boat. It was red.\n\nKind regards\nBob\nTel: 1\n"


def test_own_text_variants():
    want = "We saw the boat. It was red."
    quoted = PLAIN + "\nOn 1 Jan 2024 at 10:00, X <x@y.z> wrote:\n> Other text\n> > deep\n"
    top = "On 1 Jan 2024 at 10:00, X <x@y.z> wrote:\n> Other text\n\n" + PLAIN
    original = PLAIN + "\n-----Original Message-----\nFrom: X\nSent: 1\n\nOther text.\n"
    above = "-----Original Message-----\nFrom: X\nSent: 1\n\nOther text.\n\nYours\nX\n\n\n" + PLAIN
    disclaimer = PLAIN.replace("Kind regards\nBob\nTel: 1\n", "") + "---\nThis message is secret.\n"
    for body in (PLAIN, quoted, top, original, above, disclaimer, PLAIN.replace("\n", "\r\n"), PLAIN.replace("Kind regards", "-- ")):
        assert mail.own_text("From: a\nSubject: b\n\n" + body) == want, body
    packed = base64.encodebytes(PLAIN.encode()).decode()
    assert mail.own_text(f"From: a\nContent-Transfer-Encoding: base64\n\n{packed}") == want
    html = "From: a\nContent-Type: text/html\n\n<html><body><div>Hello Ann,<br></div><p>We <b>saw</b>&nbsp;the boat. It was red.</p><blockquote>Other <blockquote>x</blockquote></blockquote></body></html>"
    assert mail.own_text(html).replace("\xa0", " ") == want


def test_multipart_unclosed_and_nested():
    raw = (
        'From: a\nContent-Type: multipart/mixed;\n boundary="B"\n\npreamble\n--B\nContent-Type: multipart/alternative; boundary=C\n\n--C\nContent-Type: text/plain\n\nplain\n'
        "--C\nContent-Type: text/html\n\n<p>html</p>\n--C--\n--B\nContent-Type: text/csv\nContent-Disposition: attachment\n\na,b\n--B\nContent-Type: image/png\nContent-Transfer-Encoding: base64\n\nAAAA"
    )
    assert [(t.part.kind, t.part.attached, t.text.strip()) for t in mail.texts(raw)] == [("text/plain", False, "plain"), ("text/html", False, "html"), ("text/csv", True, "a,b")]


@pytest.mark.parametrize("raw", ["", "no headers at all", "From: x", "Content-Type: multipart/mixed\n\nno boundary", "Content-Transfer-Encoding: base64\n\n!!!=A", "Content-Type: text/plain; charset=nope\nContent-Transfer-Encoding: quoted-printable\n\n=ZZ=E9", "\n\n\n", "A: b\n\n" + "x" * 2_000_000])
def test_nothing_raises(raw):
    mail.own_text(raw)
    mail.texts(raw)


def test_offsets_lead_back():
    text = "Äpfel und Birnen, viele Worte " * 8
    for encoding, body in (("base64", base64.encodebytes(text.encode()).decode()), ("quoted-printable", quopri.encodestring(text.encode()).decode()), ("8bit", text)):
        raw = f"From: a\nContent-Transfer-Encoding: {encoding}\n\n{body}"
        read = mail.texts(raw)[0]
        at, end = read.origin(read.text.index("Birnen"), read.text.index("Birnen") + 5)
        if encoding == "8bit":
            assert raw[at:end] == "Birnen"
        elif encoding == "quoted-printable":
            assert raw[at:end].replace("=\n", "") == "Birnen"
        else:
            assert b"Birnen" in base64.b64decode(raw[read.part.start :].replace("\n", ""))[: (end - read.part.start) * 3 // 4 + 3] and at >= read.part.start


def test_places_in_html():
    markup = "<html><head><style>p {x}</style></head><body><p>a &amp; b<br>caf&eacute; <b>d</b></p></body></html>"
    text, places = mail.html_text(markup), mail.html_places(markup)
    assert len(text) == len(places)
    for ch in "abd":
        assert markup[places[text.index(ch)]] == ch
    assert markup[places[text.index("é")] :].startswith("&eacute;")
    raw = f"From: a\nContent-Type: text/html\n\n{markup}"
    read = mail.texts(raw)[0]
    at, end = read.origin(read.text.index("caf"), read.text.index("é"))
    assert raw[at:end].startswith("caf")


def test_attached_messages_of_any_depth():
    inner = "From: x\nContent-Transfer-Encoding: quoted-printable\n\nCaf=C3=A9 inside\n"
    raw = f"From: a\nContent-Type: multipart/mixed; boundary=B\n\n--B\nContent-Type: message/rfc822\n\n{inner}\n--B--\n"
    assert [t.text.strip() for t in mail.texts(raw)] == ["Café inside"]
    packed = base64.encodebytes(inner.encode()).decode()
    coded = f"From: a\nContent-Type: multipart/mixed; boundary=B\n\n--B\nContent-Type: message/rfc822\nContent-Transfer-Encoding: base64\n\n{packed}\n--B--\n"
    read = mail.texts(coded)[0]
    at, end = read.origin(read.text.index("inside"), read.text.index("inside") + 5)
    assert read.text.strip() == "Café inside" and coded.index(packed[:10]) <= at < end <= coded.index("--B--")
    deep = "plain at the bottom"
    for n in range(40):
        deep = f"Content-Type: multipart/mixed; boundary=N{n}\n\n--N{n}\n{deep if n else 'Content-Type: text/plain' + chr(10) * 2 + deep}\n--N{n}--\n"
    assert [t.text.strip() for t in mail.texts(deep)] == ["plain at the bottom"]


def test_text_between_quotes_and_rules_is_own():
    html = "Content-Type: text/html\n\n<blockquote>q1 <blockquote>q2</blockquote> q3</blockquote><p>Mine.</p><blockquote>q4</blockquote><p>Also mine.</p>"
    assert mail.own_text(html).split() == ["Mine.", "Also", "mine."]
    assert mail.own_text("From: a\n\nFirst point.\n---\nSecond point.\nNotice:\nThe shop is shut.") == "First point.\n---\nSecond point.\nNotice:\nThe shop is shut."
    assert mail.own_text("From: a\n\n> asked one\nAnswer one.\n> asked two\nAnswer two.") == "Answer one.\nAnswer two."
    assert mail.own_text("From: a\n\n-----Original Message-----\nFrom: b\nSent: 1\n\nTheirs.\n\nX wrote:\n> old\n\nMine below.") == "Mine below."
