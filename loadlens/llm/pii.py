"""Surrogates for personal data: keyed, type-consistent and collision-checked.

Detected: e-mail addresses, phone numbers, payment cards, IPv4 and MAC addresses, IBANs, US social
security numbers, cloud access keys, values of password / token / key assignments, long hex keys, and
names in any script after a title, in mail headers, after a letter's closing, or of two or more words led by a
common given name (and the same names elsewhere in that text).  A mention's canonical value (case
and separators removed) is replaced by a surrogate drawn from an HMAC of a secret key, the kind
and the value, so one value has one surrogate in every document (coreference).  The surrogate keeps
the kind's rules: digits stay digits and letters letters, cards keep brand and check digit, IBANs
country and check digits, phone numbers their plan, IPs their private or public class, names
their script, gender and letter case; separators and case come from the mention.

Distinctness is checked over the whole corpus: a surrogate that equals a real value, or that two
values draw, goes to at most one of them (the smallest), the others draw again.  Only values that
needed another draw have to be known when texts are rewritten; every other surrogate is
recomputed from the key in place.

Defined cases: null text stays null with no entities; overlapping matches: the earlier kind of
``KINDS`` wins; repeated rows are rewritten alike; whole texts of any length; an empty table
gives an empty table; columns ``n_entities`` of the input are replaced.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import narrow, salted_join, ship, stored

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: Kinds and patterns, by priority; group ``v`` is the value where the match has a prefix.
KINDS = {
    "email": r"(?<![\w.+%-])[^\W_][\w.+%-]{0,63}@[A-Za-z0-9](?:[A-Za-z0-9-]{0,62}\.)+[A-Za-z]{2,24}(?![\w-])",
    "access_key": r"(?<!\w)(?:AKIA|ASIA)[A-Z0-9]{16}(?!\w)",
    "secret": r"(?i:(?<!\w)(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key))\s{0,3}[=:]\s{0,3}"
              r"[\"']?(?P<secret_v>[^\s\"']{5,}[^\s\"'.,;:!?)])",
    "hex_key": r"(?<!\w)[0-9a-fA-F]{32,}+(?!\w)",
    "mac": r"(?<![\w:])(?:[0-9A-Fa-f]{2}:){5}[0-9A-Fa-f]{2}(?![\w:])",
    "ipv4": rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\w|\.\d)",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "card": r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-])",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}|"
             r"\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4})(?!\w)",
}
# Titles by gender.
TITLES = {"m": "Mr Herr Señor Monsieur господин г-н пан Κύριος κύριος κύριο κ السيد מר श्री".split(),
          "f": "Mrs Ms Miss Frau Señora Señorita Madame Mme Mademoiselle госпожа г-жа пані Κυρία κυρία السيدة גברת श्रीमती".split(),
          "x": "Dr Prof Professor".split()}
_GENDER = {t: g for g, ts in TITLES.items() for t in ts}


def _letters():
    """Regex ranges of letters and of the marks written with them, which ``\\w`` leaves out."""
    out, low = [], None
    for c in range(sys.maxunicode + 2):
        inside = c <= sys.maxunicode and unicodedata.category(chr(c)) in ("Lu", "Ll", "Lt", "Lm", "Lo", "Mn", "Mc")
        if inside and low is None:
            low = c
        elif not inside and low is not None:
            out.append(f"\\U{low:08x}-\\U{c - 1:08x}")
            low = None
    return "".join(out)


_WORD = r"[^\W\d_][%s]*(?:[-'’][^\W\d_][%s]*)*" % (2 * (_letters(),))
NAME = re.compile(rf"(?<![\w-])(?P<t>{'|'.join(map(re.escape, sorted(_GENDER, key=len, reverse=True)))})\.? (?P<n>{_WORD}(?: {_WORD}){{0,2}})")
# Common given names by gender that are hardly ever other words; names of two or more words that begin with one need no title.
GIVEN = {"m": "Ahmed Alexander Andreas Andrzej Anthony Carlos Christopher Daniel Dmitri Fernando Francisco Giovanni Giuseppe "
              "Hans Henrik Ivan Jean Johannes John Jonathan José Juan Jürgen Krzysztof Lars Łukasz Luis Matthew Mehmet Michael "
              "Miguel Mohamed Mohammed Muhammad Mustafa Nicholas Nikolai Paolo Paweł Pedro Peter Pierre Piotr Richard Robert "
              "Stephen Sven Thomas Tomasz Vladimir Wolfgang Yusuf Александр Алексей Андрей Владимир Дмитрий Иван Михаил "
              "Николай Сергей Γιώργος Νίκος Андрій Олександр Сергій".split(),
         "f": "Agnieszka Aisha Anna Ayşe Catherine Charlotte Elena Elizabeth Emma Fatima Fatma Giulia Hannah Ingrid Isabella "
              "Jennifer Jessica Johanna Julia Katarzyna Laura Linda Magdalena Małgorzata Margaret Maria María Martha Mary "
              "Michelle Natalia Olga Patricia Rebecca Sarah Sophie Stephanie Susan Svetlana Ursula Zeynep Анна Екатерина "
              "Елена Мария Наталья Ольга Светлана Татьяна Μαρία Ελένη Олена Наталія".split()}
_GIVEN = {n: g for g, ns in GIVEN.items() for n in ns}
RUN = re.compile(rf"(?<![\w-]){_WORD}(?: {_WORD})+")
# Header lines that hold a person, and closings of letters that one follows.
CUED = re.compile(rf"^[ \t>]*(?i:From|To|Cc|Bcc|Sender|Reply-To|Signed|Signature|Von|An|De|От|Кому):[ \t]*[\"']?(?P<n>{_WORD}(?: {_WORD}){{1,2}})"
                  rf"[\"']?[ \t]*(?=[<(\[,;\r\n]|$)|"
                  r"^[ \t>]*(?i:(?:(?:best|kind|warm)(?:est)? )?regards|sincerely(?: yours)?|yours (?:sincerely|truly|faithfully)|best wishes|cheers|"
                  r"mit freundlichen grüßen|viele grüße|cordialement|saludos|atentamente|с уважением)[,.!]?[ \t]*\r?\n\s{0,4}"
                  rf"(?P<s>{_WORD}(?: {_WORD}){{0,2}})[ \t]*\r?$", re.M)
FOUND = re.compile("|".join(f"(?P<{k}>{p})" for k, p in KINDS.items()))
UNASSIGNED = re.compile("|".join(f"(?P<{k}>{p})" for k, p in KINDS.items() if k != "secret"))
VALUE = re.compile(r"[^\s\"']*")
SPACE = re.compile(r"\s")
HINT = re.compile(r"[0-9@]+|A[KS]IA")  # every kind but names has one of these
REACH = 260  # characters of a mention before the word of its first hint and after its last hint, at most
HEX = re.compile(r"[0-9a-f]+|[0-9A-F]+")
# Syllables of invented names by script, and endings by gender.
SYLLABLES = {"latin": "al bre cor dan el fa gar hel is jo ka lem mar nor ol per ro sel tam ul vin wes".split(),
             "cyrillic": "ал бо вер гор да ев жен зар ил ка лем мар нор ол пет ро сав там уль фе".split(),
             "greek": "αλ βε γα δη ελ ζω θε κα λε μαρ νι ολ πε ρο σαν τα φι χρι".split(),
             "arabic": "با تر جم حس دا را سل شا صر طا عم فا كر لم ما نور هد يس".split(),
             "hebrew": "אב בן גל דן הד זיו חן טל יר כר לי מור נעם סה עד פז רון שי".split(),
             "devanagari": "अ क ग च ज त द न प ब म य र ल व स ह".split(),
             "hangul": "가 나 도 라 미 보 서 우 재 준 진 하 현 혜 호".split(),
             "hiragana": "あ き く さ し た な は ま み や ゆ ら り".split(),
             "katakana": "ア キ ク サ シ タ ナ ハ マ ミ ヤ ユ ラ リ".split(),
             "cjk": "安 文 华 明 林 德 海 江 山 志 国 平 春 秋 雨 云 天 宁".split()}
ENDINGS = {("given", "latin", "m"): ["rd", "n", "us", "ton"], ("given", "latin", "f"): ["a", "ina", "elle", "ia"],
           ("given", "latin", "x"): ["in", "ey", "is", "en"], ("family", "latin", ""): ["son", "er", "well", "mond"],
           ("given", "cyrillic", "m"): ["ан", "ор", "ей", "ил"], ("given", "cyrillic", "f"): ["ина", "ана", "ия", "ела"],
           ("given", "cyrillic", "x"): ["ан", "ей", "ин", "ор"], ("family", "cyrillic", "m"): ["ов", "ин", "ев", "ский"],
           ("family", "cyrillic", "f"): ["ова", "ина", "ева", "ская"], ("family", "cyrillic", "x"): ["енко", "ук", "ян", "ых"]}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _iban_rest(value: str) -> int:
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97


def canonical(kind: str, mention: str) -> str | None:
    """The value a mention stands for, or None when it breaks the kind's rules."""
    if kind == "email":
        return mention.lower()
    if kind == "mac":
        return mention.lower()
    if kind == "iban":
        v = mention.replace(" ", "")
        return v if 15 <= len(v) <= 34 and _iban_rest(v) == 1 else None
    if kind in ("ssn", "card", "phone"):
        v = re.sub(r"\D", "", mention)
        if kind == "card":
            return v if luhn(v) or len(v) == 16 else None
        if kind == "phone":
            return ("+" if mention.startswith("+") else "") + v if 8 <= len(v) <= 15 else None
        return v
    return mention


def script_of(word: str) -> str:
    """The first word of the Unicode name of a word's first letter, as ``latin``, ``greek``, ``cjk``."""
    return re.split(r"[ -]", unicodedata.name(word[0], "LATIN"))[0].lower()


@lru_cache(None)
def syllables(script: str) -> list[str]:
    """Syllables of a script; of one without a set of its own, its letters."""
    if script in SYLLABLES:
        return SYLLABLES[script]
    return [c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) in ("Ll", "Lo")
            and unicodedata.name(c, "").lower().startswith(script + " ")] or SYLLABLES["latin"]


def _upper(word: str) -> bool:
    return unicodedata.category(word[0]) in ("Lu", "Lt")


def _name_words(words: list[str]) -> list[str]:
    """The words a name has at the start of ``words``: capitals, or the first one in a script without letter case."""
    if not _upper(words[0]):
        return words[:1] if unicodedata.category(words[0][0]) == "Lo" else []
    return words[:next((i for i, w in enumerate(words) if not _upper(w)), len(words))]


def names_in(text: str) -> dict[str, str]:
    """Name words after a title, a header or a closing, or led by a common given name: word as written -> kind
    (``given:script:gender`` or ``family:script:gender``, the same for all forms of one word)."""
    out: dict[str, str] = {}
    kinds: dict[str, str] = {}

    def add(words, gender, alone="family"):
        for i, w in enumerate(words):
            script = script_of(w)
            part = "given" if i < len(words) - 1 else "family" if i else alone
            kind = f"{part}:{script}:{gender if part == 'given' or script != 'latin' else ''}"
            out[w] = kinds.setdefault(w.casefold(), kind)

    for m in NAME.finditer(text):
        add(_name_words(m["n"].split(" ")), _GENDER[m["t"]])
    for m in CUED.finditer(text):
        words = (m["n"] or m["s"]).split(" ")
        if all(map(_upper, words)):
            add(words, _GIVEN.get(words[0], "x"), "given")
    for m in RUN.finditer(text) if not _GIVEN.keys().isdisjoint(text.split()) else ():
        words = m[0].split(" ")
        at = 0
        while at < len(words) - 1:
            got = _name_words(words[at:at + 3]) if words[at] in _GIVEN else []
            if len(got) > 1:
                add(got, _GIVEN[got[0]])
            at += max(1, len(got))
    return out


def _near_hints(text: str):
    """Stretches of the text around its hints, in order and apart; none begins or ends inside a hint's word."""
    a = b = None
    for m in HINT.finditer(text):
        if b is None or m.start() - REACH > b:
            start = max(b or 0, _word_start(text, m.start(), b or 0) - REACH)
            if b is None or start > b:
                if b is not None:
                    yield a, b
                a = start
        if b is None or m.end() + REACH > b:
            b = _word_end(text, m.end() + REACH)
    if b is not None:
        yield a, b


def _word_start(text: str, at: int, low: int) -> int:
    while at > low and not text[at - 1].isspace():
        at -= 1
    return at


def _word_end(text: str, at: int) -> int:
    m = SPACE.search(text, min(at, len(text)))
    return m.start() if m else len(text)


def _found(text: str, start: int, stop: int):
    """Matches of the kinds in ``text[start:stop]``; an assigned value without a digit is no secret, but may hold other kinds."""
    while m := FOUND.search(text, start, stop):
        start = m.end()
        if m["secret"] is None or any(map(str.isdecimal, m["secret_v"])):
            yield m
            continue
        start = VALUE.match(text, m.start("secret_v"), stop).end()
        yield from UNASSIGNED.finditer(text, m.start("secret_v"), start)


def mentions(text: str | None) -> list[tuple[int, int, str, str]]:
    """``(start, end, kind, value)`` of every mention, in order, without overlaps."""
    if not text:
        return []
    found, end = [], 0
    for start, stop in _near_hints(text):
        for m in _found(text, max(start, end), stop):
            end = m.end()
            kind = m.lastgroup if m.lastgroup != "secret_v" else "secret"
            a, b = m.span("secret_v") if kind == "secret" else m.span()
            value = canonical(kind, text[a:b])
            if value is not None:
                found.append((a, b, kind, value))
    names = names_in(text)
    if names:
        taken = [(a, b) for a, b, _, _ in found]
        kinds = {w.casefold(): k for w, k in names.items()}
        forms = sorted({f for w in names for f in (w, w.upper())}, key=len, reverse=True)
        words = re.compile(r"(?<![\w@.])(?:" + "|".join(map(re.escape, forms)) + r")(?!\w|@)", re.I)
        for m in words.finditer(text):
            kind = kinds.get(m[0].casefold())
            if kind and not m[0][0].islower() and not any(a < m.end() and m.start() < b for a, b in taken):
                found.append((m.start(), m.end(), "name:" + kind, m[0].casefold()))
        found.sort()
    return found


def _swap(value: str, draw, hexed: bool) -> str:
    out = []
    for c in value:
        if hexed and c in "0123456789abcdefABCDEF":
            out.append("0123456789ABCDEF"[draw(16)] if c.isupper() else "0123456789abcdef"[draw(16)])
        elif c.isdecimal():
            out.append(str(draw(10)))
        elif c.isalpha() and c.isascii():
            out.append(chr((97 if c.islower() else 65) + draw(26)))
        elif c.isalpha():
            out.append("abcdefghijklmnopqrstuvwxyz"[draw(26)])
        else:
            out.append(c)
    return "".join(out)


def surrogate(key: bytes, kind: str, value: str, attempt: int = 0) -> str:
    """The canonical surrogate of a canonical value at a draw."""
    state = [int.from_bytes(hmac.new(key, f"{kind}\0{value}\0{attempt}".encode("utf-8", "surrogatepass"),
                                     hashlib.sha512).digest(), "big"), 0]

    def draw(n: int) -> int:
        if state[0] < n << 16:
            state[1] += 1
            state[0] = int.from_bytes(hmac.new(key, f"{kind}\0{value}\0{attempt}\0{state[1]}".encode(
                "utf-8", "surrogatepass"), hashlib.sha512).digest(), "big")
        state[0], r = divmod(state[0], n)
        return r

    if kind == "email":
        local, domain = value.rsplit("@", 1)
        labels = domain.split(".")
        fixed = 2 if labels[-2:-1] == ["example"] else 1
        labels = [_swap(x, draw, False) for x in labels[:-fixed]] + labels[-fixed:]
        more = "x" * (attempt // 4)  # short local parts run out
        return f"{_swap(local + more, draw, False)}@{'.'.join(labels)}"
    if kind == "access_key":
        return value[:4] + "".join("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"[draw(32)] for _ in value[4:])
    if kind == "ipv4":
        o = [int(x) for x in value.split(".")]
        rest = [draw(256), draw(256), 1 + draw(254)]
        if o[0] == 10 or (attempt >= 4 and (o[:2] == [192, 168] or (o[0] == 172 and 16 <= o[1] < 32))):
            return ".".join(map(str, [10, *rest]))  # the largest private range, also once a smaller one runs out
        if o[0] == 127:
            return ".".join(map(str, [o[0], *rest]))
        if o[:2] == [192, 168] or (o[0] == 172 and 16 <= o[1] < 32):
            return ".".join(map(str, [o[0], o[1] if o[0] == 192 else 16 + draw(16), *rest[1:]]))
        first = 11 + draw(116)  # public: 11 to 126
        return ".".join(map(str, [first, *rest]))
    if kind == "iban":
        body = "".join(str(draw(10)) if c.isdigit() else chr(65 + draw(26)) for c in value[4:])
        return f"{value[:2]}{98 - _iban_rest(value[:2] + '00' + body):02d}{body}"
    if kind == "card":
        body = value[:1] + "".join(str(draw(10)) for _ in value[1:-1])
        if not luhn(value):
            return body + str(draw(10))
        return next(body + str(d) for d in range(10) if luhn(body + str(d)))
    if kind == "ssn":
        return f"{1 + draw(665):03d}{1 + draw(99):02d}{1 + draw(9999):04d}"
    if kind == "phone":
        if value.startswith("+1") and len(value) == 12:
            return f"+1{2 + draw(8)}{draw(100):02d}{2 + draw(8)}{draw(100):02d}{draw(10_000):04d}"
        if len(value) == 10 and value[0] != "+":
            return f"{2 + draw(8)}{draw(100):02d}{2 + draw(8)}{draw(100):02d}{draw(10_000):04d}"
        kept = 3 if value.startswith("+") else 1
        return value[:kept] + "".join(str(draw(10)) for _ in value[kept:])
    if kind.startswith("name:"):
        part, script, gender = kind[5:].split(":")
        s = syllables(script)
        body = "".join(s[draw(len(s))] for _ in range(2 + attempt // 2))
        end = ENDINGS.get((part, script, gender), [""])
        return body + end[draw(len(end))]
    return _swap(value, draw, kind in ("hex_key", "mac") or (bool(HEX.fullmatch(value)) and len(value) >= 8))


def space(kind: str) -> str:
    """Values of one space are told apart from each other: all names together, else the kind."""
    return "name" if kind.startswith("name:") else kind


def render(kind: str, mention: str, new: str) -> str:
    """A canonical surrogate in the format of the mention."""
    if kind in ("phone", "card", "ssn", "iban"):
        left = iter(new.lstrip("+") if kind != "iban" else new)
        return "".join(next(left) if c.isalnum() else c for c in mention)
    if kind.startswith("name:"):
        return new.upper() if mention.isupper() and len(mention) > 1 else new[:1].upper() + new[1:]
    if kind in ("email", "mac") and mention.upper() == mention:
        return new.upper()
    return new


def rewrite(text: str | None, key: bytes, again: dict[tuple[str, str], int]) -> tuple[str | None, int]:
    """The text with its surrogates and the number of mentions; ``again`` has draws other than the first."""
    got = mentions(text)
    if not got:
        return text, 0
    out, at = [], 0
    for a, b, kind, value in got:
        out += [text[at:a], render(kind, text[a:b], surrogate(key, kind, value, again.get((kind, value), 0)))]
        at = b
    return "".join([*out, text[at:]]), len(got)


def redraws(entities: DataFrame, key: bytes, most: int = 64) -> DataFrame:
    """``(kind, value, attempt)`` of the distinct ``(kind, value)`` whose first draw is not theirs."""

    def draw(attempt: int):
        def run(batches):
            import pyarrow as pa

            for b in batches:
                kinds, values = b.column(0).to_pylist(), b.column(1).to_pylist()
                new = [surrogate(key, k, v, attempt) for k, v in zip(kinds, values)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array([space(k) for k in kinds]), pa.array(new, pa.string())],
                    ["kind", "value", "space", "new"])
        return run

    real = entities.select(F.regexp_replace("kind", "^name:.*", "name").alias("space"), F.col("value").alias("new"))
    taken, pending, out = None, entities, None
    for attempt in range(most):
        drawn = pending.mapInArrow(draw(attempt), "kind string, value string, space string, new string")
        first = drawn.groupBy("space", "new").agg(F.min(F.struct("value", "kind")).alias("w"))
        if attempt < most // 2:  # a space may be full of real values; draws stay distinct from each other
            first = first.join(real.distinct(), ["space", "new"], "left_anti")
        if taken is not None:
            first = first.join(taken, ["space", "new"], "left_anti")
        won = stored(first.select("space", "new", F.col("w.kind").alias("kind"), F.col("w.value").alias("value")), "drawn")
        if attempt:
            got = won.select("kind", "value", F.lit(attempt).alias("attempt"))
            out = got if out is None else out.unionByName(got)
        rest = stored(pending.join(won, ["kind", "value"], "left_anti"), "pending")
        if rest.count() == 0:
            break
        wins = won.select("space", "new")
        taken = wins if taken is None else taken.unionByName(wins)
        pending = rest
    else:
        raise RuntimeError(f"surrogates still collide after {most} draws")
    return out if out is not None else entities.sparkSession.createDataFrame([], "kind string, value string, attempt int")


def surrogate_pii(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text",
                  sent_rows: int = 100_000) -> DataFrame:
    """``docs`` with personal data in ``text_col`` replaced, plus ``n_entities`` (mentions replaced).

    Redrawn values are broadcast when they are at most ``sent_rows``; beyond that they are joined
    to the documents that mention them.
    """
    spark = docs.sparkSession
    ship(spark)

    def detect(batches):
        import pyarrow as pa

        for b in batches:
            rows = {(i, k, v) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist())
                    for _, _, k, v in mentions(t)}
            cols = list(zip(*rows)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()),
                                              pa.array(cols[2], pa.string())], ["id", "kind", "value"])

    found = stored(narrow(docs, id_col, text_col).mapInArrow(detect, "id long, kind string, value string"), "mentions")
    again = stored(redraws(stored(found.select("kind", "value").distinct(), "entities"), key), "redraws")
    n = again.count()
    keep = [c for c in docs.columns if c != "n_entities"]

    def apply(text, extra):
        import pandas as pd

        got = [rewrite(t, key, e) for t, e in zip(text, extra)]
        return pd.DataFrame({"text": [g[0] for g in got], "n": [g[1] for g in got]})

    if n <= sent_rows:
        sent = spark.sparkContext.broadcast({(r["kind"], r["value"]): r["attempt"] for r in again.collect()} if n else {})

        @F.pandas_udf("text string, n long")
        def replace(text):
            return apply(text, [sent.value] * len(text))

        wide = docs.select(*[docs[f"`{c}`"] for c in keep], replace(docs[f"`{text_col}`"]).alias("_new"))
        return wide.select(*[F.col("_new.text").alias(c) if c == text_col else F.col(f"`{c}`") for c in keep],
                           F.col("_new.n").alias("n_entities"))
    pair = F.concat_ws("\0", "kind", "value").alias("pair")
    per_doc = (salted_join(found.select("id", pair), again.select(pair, "attempt"), "pair", ["id"])
               .groupBy("id").agg(F.collect_set(F.struct("pair", "attempt")).alias("extra")))

    @F.pandas_udf("text string, n long")
    def replace_with(text, extra):
        maps = [{tuple(x["pair"].split("\0", 1)): x["attempt"] for x in (e if e is not None else [])} for e in extra]
        return apply(text, maps)

    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in keep]).alias("row"), docs[f"`{id_col}`"].cast("long").alias("id"))
    new = replace_with(F.col(f"row.`{text_col}`"), F.col("extra"))
    wide = rows.join(per_doc, "id", "left").select("row", new.alias("_new"))
    return wide.select(*[F.col("_new.text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in keep],
                       F.col("_new.n").alias("n_entities"))
