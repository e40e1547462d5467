"""Personal data by anchor expansion.

An Aho-Corasick automaton goes over each whole text once and stops at anchors: at-signs, plus-signs, digits, "://" and
cues such as "IBAN" or "account". At each, a parser of that anchor alone goes left and right to the bounds of what may
stand there, and checks it. Base kinds are those of four patterns, found leftmost and without overlap within a kind:

    email  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+
    ip     [0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)     each part at most 255
    card   [0-9]([\\x20-]?[0-9])+                     13 to 19 digits, Luhn's sum right
    phone  \\+[0-9][\\x20().0-9-]+[0-9]               9 to 15 digits

The method adds `login` (scheme://user[:password]@host), `iban` (a cue, then an account number whose check digits are
right) and `account` (a cue, then 6 to 17 digits).

Cases: a null text is an empty one. A null doc_id stays null; repeated rows are judged each; an empty table gives no
row; other columns are ignored. Offsets count code points; the end is exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import keyed, prepare, unkeyed

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "login", "iban", "account")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_SCHEME = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*\Z")
_USER = re.compile(r"[A-Za-z0-9._~!$&'()*+,;=%-]+(?::[A-Za-z0-9._~!$&'()*+,;=%:-]*)?@[A-Za-z0-9.-]+")
_IBAN = re.compile(r"[ :=#]{0,3}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})(?![A-Za-z0-9])")
_ACCOUNT = re.compile(r"(?: ?(?:no|nr|number|num)\.?)?[ :=#]{1,3}([0-9](?:[ -]?[0-9]){5,16})(?![0-9])")
_CUES = {"iban": ("IBAN", "Iban", "iban"), "account": ("account", "Account", "ACCOUNT", "acct", "Acct", "ACCT")}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n += n - 9 * (n > 4)
        total += n
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def _checked(account: str) -> bool:
    turned = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


class Finder:
    def __init__(self):
        import ahocorasick

        self.anchors = ahocorasick.Automaton()
        for x in "@+0123456789":
            self.anchors.add_word(x, x if x in "@+" else "0")
        self.anchors.add_word("://", "://")
        for kind, cues in _CUES.items():
            for x in cues:
                self.anchors.add_word(x, kind)
        self.anchors.make_automaton()

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """(kind, start, end), by kind in the order of KINDS, then by start."""
        found: dict[str, list[tuple[int, int]]] = {}
        mail_end = ip_end = chain_end = run_end = 0
        for at, anchor in self.anchors.iter(text):
            if anchor == "0":
                if at < run_end:
                    continue
                run_end = at + 1
                if at >= ip_end and (m := _IP.match(text, at)):
                    ip_end = m.end()
                    if all(map(_small, m.groups())):
                        found.setdefault("ip", []).append(m.span())
                if at >= chain_end and (m := _CHAIN.match(text, at)):
                    chain_end = m.end()
                    digits = _NOT_DIGIT.sub("", m[0]) if chain_end - at <= 37 else ""
                    if 13 <= len(digits) <= 19 and luhn(digits):
                        found.setdefault("card", []).append(m.span())
                while run_end < len(text) and "0" <= text[run_end] <= "9":
                    run_end += 1
            elif anchor == "@":
                start = at
                while start > mail_end and text[start - 1] in _LOCAL:
                    start -= 1
                if start < at and (m := _DOMAIN.match(text, at + 1)):
                    mail_end = m.end()
                    found.setdefault("email", []).append((start, mail_end))
            elif anchor == "+":
                if m := _PHONE.match(text, at):
                    if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                        found.setdefault("phone", []).append(m.span())
            elif anchor == "://":
                scheme = _SCHEME.search(text[max(0, at - 34) : at - 2])
                if scheme and (m := _USER.match(text, at + 1)):
                    found.setdefault("login", []).append((at - 2 - len(scheme[0]), m.end()))
            elif anchor == "iban":
                if (m := _IBAN.match(text, at + 1)) and _checked(m[1].replace(" ", "")):
                    found.setdefault("iban", []).append(m.span(1))
            elif m := _ACCOUNT.match(text, at + 1):
                found.setdefault("account", []).append(m.span(1))
        return [(k, a, b) for k in KINDS for a, b in found.get(k, ())]


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def _run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    finder = Finder()
    for batch in batches:
        spans = [[{"kind": k, "start": a, "end": b} for k, a, b in finder.spans(x)] for x in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, _SPANS)], ["_id", "spans"])


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, spans (kind, start, end), base and added ones, by kind and start. No shuffle: each text alone."""
    prepare(docs.sparkSession)
    out = keyed(docs, id_col, text_col).mapInArrow(_run, "_id long, spans array<struct<kind:string,start:int,end:int>>")
    return out.select(unkeyed().alias("doc_id"), "spans")


def personal_data(docs: DataFrame, **more) -> DataFrame:
    """find_personal_data with its counts and digest."""
    found = find_personal_data(docs, **more)
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, BASE_KINDS), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
