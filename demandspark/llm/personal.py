"""Personal data in texts: patterns propose spans, checksums confirm them, nearby words move their score.

Every kind has one pattern, which is matched from left to right without overlaps.  A replacement puts a mark
around each match, and a split at the marks gives the pieces between matches and the matches by turns; running sums of their
lengths are the places.  A match scores `prior` points for its shape, `confirmed` for its checksum or range check, `near` if a
word of its context stands close by, and loses `far` if a word stands there that speaks against it.  Base spans are kept
whatever their score; other matches are spans from `THRESHOLD` points on, and only if their check confirms them.  All of it is
built-in SQL functions.
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 60
BEFORE, AFTER = 48, 24  # code points of context on either side, up to the neighbouring match of the same kind

_MARK, _OTHER = "\x01", "\x02"  # neither is part of any pattern
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


def luhn(digits: Column) -> Column:
    """Whether the digits pass the Luhn check: from the right, each second one counts double, less 9 above 9."""
    count = F.length(digits)
    value = lambda j: F.substring(digits, count - j + 1, F.lit(1)).cast("int")
    part = lambda j: F.when(j % 2 == 1, value(j)).otherwise(2 * value(j) - F.when(value(j) > 4, 9).otherwise(0))
    return F.aggregate(F.sequence(F.lit(1), count), F.lit(0), lambda total, j: total + part(j)) % 10 == 0


def mod_97(code: Column) -> Column:
    """Whether letters and digits pass the mod-97 check of account numbers: first four behind the rest, A = 10 to Z = 35."""
    count = F.length(code)
    letter = lambda j: F.ascii(F.substring(code, (j + 3) % count + 1, F.lit(1)))
    step = lambda rest, j: F.when(letter(j) < 65, rest * 10 + letter(j) - 48).otherwise(rest * 100 + letter(j) - 55) % 97
    return F.aggregate(F.sequence(F.lit(1), count), F.lit(0), step) == 1


def _digits(found: Column) -> Column:
    return F.translate(found, "+-(). ", "")


def _outside(m: Column) -> Column:
    """No letter or digit touches the match."""
    return ~m["before"].rlike("[A-Za-z0-9]\\z") & ~m["after"].rlike("^[A-Za-z0-9]")


def _ip(m: Column) -> Column:
    return m["found"].rlike(f"^{_OCTET}(?:[.]{_OCTET}){{3}}$")


def _card(m: Column, least: int, most: int) -> Column:
    digits = _digits(m["found"])
    return F.when(F.length(digits).between(least, most), luhn(digits)).otherwise(False)


def _iban(m: Column) -> Column:
    code = F.translate(m["found"], " ", "")
    return F.when(F.length(code).between(15, 34) & _outside(m), mod_97(code)).otherwise(False)


@dataclass(frozen=True)
class Kind:
    """A kind of personal data.

    `pattern` is in Java's syntax; possessive loops and look-behinds only keep long runs of characters from being read again and
    again.  `hint` must hold for a text to be searched at all.  `base` and `check` judge a match (found, before, after).
    """

    name: str
    pattern: str
    hint: str
    base: Callable[[Column], Column] | None
    check: Callable[[Column], Column]
    prior: int
    confirmed: int
    near: int
    far: int
    context: tuple[str, ...]
    against: tuple[str, ...] = ()


# The order is the order of kinds in results.
KINDS: tuple[Kind, ...] = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
        base=lambda m: F.lit(True),
        check=lambda m: m["found"].rlike("[.][A-Za-z]{2,24}$"),
        prior=60,
        confirmed=20,
        near=20,
        far=30,
        context=("mail", "email", "e-mail", "contact", "write", "kontakt", "correo", "courriel"),
        against=("example", "noreply", "no-reply"),
    ),
    Kind(
        "ip",
        r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}",
        "",
        base=_ip,
        check=lambda m: _ip(m) & _outside(m),
        prior=40,
        confirmed=20,
        near=25,
        far=25,
        context=("ip", "address", "host", "server", "login", "client", "from"),
        against=("version", "release", "section", "chapter", "build"),
    ),
    Kind(
        "card",
        r"[0-9](?:[ -]?+[0-9])++",
        "",
        base=lambda m: _card(m, 16, 19),
        check=lambda m: _card(m, 13, 19),
        prior=10,
        confirmed=40,
        near=30,
        far=30,
        context=("card", "visa", "mastercard", "amex", "credit", "debit", "karte", "tarjeta", "carte", "payment"),
        against=("order", "invoice", "isbn", "serial", "tracking", "id"),
    ),
    Kind(
        "phone",
        r"\+[0-9][ ().0-9-]+[0-9]",
        "+",
        base=lambda m: F.length(_digits(m["found"])).between(8, 15),
        check=lambda m: F.length(_digits(m["found"])).between(8, 15),
        prior=30,
        confirmed=30,
        near=25,
        far=25,
        context=("phone", "tel", "call", "mobile", "cell", "fax", "telefon", "whatsapp"),
    ),
    Kind(
        "iban",
        r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [0-9]{1,3})?)",
        "",
        base=None,
        check=_iban,
        prior=10,
        confirmed=60,
        near=25,
        far=0,
        context=("iban", "account", "bank", "konto", "cuenta", "compte", "transfer"),
    ),
    Kind(
        "secret",
        r"[0-9A-Fa-f]{32,}+",
        "",
        base=None,
        check=lambda m: _outside(m) & m["found"].rlike("[0-9]") & m["found"].rlike("[A-Fa-f]"),
        prior=10,
        confirmed=30,
        near=30,
        far=30,
        context=("token", "secret", "key", "apikey", "password", "passwd", "pwd", "credential", "bearer"),
        against=("sha", "sha1", "sha256", "md5", "checksum", "commit", "digest"),
    ),
)


def _word_near(text: Column, words: tuple[str, ...]) -> Column:
    """Whether one of the words stands alone in the text; only A-Z count as upper case."""
    return F.translate(text, _UPPER, _LOWER).rlike(f"(?:^|[^a-z0-9])(?:{'|'.join(words)})(?:[^a-z0-9]|$)")


def _pieces(text: Column, kind: Kind) -> Column:
    """The pieces between matches and the matches, by turns."""
    plain = F.when(F.contains(text, F.lit(_MARK)), F.translate(text, _MARK, _OTHER)).otherwise(text)
    cut = F.split(F.regexp_replace(plain, kind.pattern, f"{_MARK}$0{_MARK}"), _MARK)
    may = F.contains(text, F.lit(kind.hint)) if kind.hint else text.rlike("[0-9]")
    return F.when(may, cut).otherwise(F.array(text))


def _running_sums(lengths: Column) -> Column:
    """Sums of the lengths up to each place, by doubling steps: n log n for n pieces."""
    steps = F.transform(F.sequence(F.lit(0), F.ceil(F.log2(F.size(lengths))).cast("int")), lambda p: F.pow(F.lit(2), p).cast("int"))
    add = lambda sums, step: F.transform(sums, lambda x, i: x + F.coalesce(F.get(sums, i - step), F.lit(0)))
    return F.aggregate(steps, lengths, add)


def _matches(pieces: str, ends: str) -> Column:
    """(first, end, found, before, after) of every match."""
    piece = lambda i: F.get(F.col(pieces), i)
    odd = F.filter(F.sequence(F.lit(0), F.size(pieces) - 1), lambda i: i % 2 == 1)
    return F.transform(
        odd,
        lambda i: F.struct(
            F.get(F.col(ends), i - 1).alias("first"),
            F.get(F.col(ends), i).alias("end"),
            piece(i).alias("found"),
            F.substring(piece(i - 1), -BEFORE, BEFORE).alias("before"),
            F.substring(piece(i + 1), 1, AFTER).alias("after"),
        ),
    )


def _judged(matches: Column, kind: Kind) -> Column:
    """Spans (kind, first, end, base, score) among the matches."""

    def judge(m: Column) -> Column:
        near = _word_near(m["before"], kind.context) | _word_near(m["after"], kind.context)
        points = F.lit(kind.prior) + F.when(near, kind.near).otherwise(0)
        if kind.against:
            far = _word_near(m["before"], kind.against) | _word_near(m["after"], kind.against)
            points = points - F.when(far, kind.far).otherwise(0)
        return F.struct(
            F.lit(kind.name).alias("kind"),
            m["first"].alias("first"),
            m["end"].alias("end"),
            (kind.base(m) if kind.base else F.lit(False)).alias("base"),
            kind.check(m).alias("confirmed"),
            points.alias("points"),
        )

    def scored(s: Column) -> Column:
        score = s["points"] + F.when(s["confirmed"], kind.confirmed).otherwise(0)
        return F.struct(s["kind"], s["first"], s["end"], s["base"], s["confirmed"], F.greatest(F.lit(0), F.least(F.lit(100), score)).alias("score"))

    kept = lambda s: s["base"] | (s["confirmed"] & (s["score"] >= THRESHOLD))
    return F.filter(F.transform(F.transform(matches, judge), scored), kept)


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and `spans`, an array of (kind, first, end, base, confirmed, score) by kind and place, of every row.

    Places count code points from 0, `end` is exclusive.  Spans of one kind never overlap.  NULL counts as an empty text, which has
    no spans.  A NULL doc_id stays NULL, repeated rows each get a row, other columns are ignored, and an empty
    table gives an empty result.  Texts of any length are searched whole.
    """
    found = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    found = found.select("doc_id", *[_pieces(F.col("body"), k).alias(k.name) for k in KINDS])
    lengths = lambda k: F.transform(F.col(k.name), lambda p: F.length(p))
    found = found.select("*", *[_running_sums(lengths(k)).alias(f"{k.name}_ends") for k in KINDS])
    found = found.select("doc_id", *[_judged(_matches(k.name, f"{k.name}_ends"), k).alias(k.name) for k in KINDS])
    return found.select("doc_id", F.concat(*[k.name for k in KINDS]).alias("spans"))


def mask(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with every span of their texts replaced by its kind in brackets, such as [email].

    Where spans of two kinds overlap, the one that starts first stands for both, the longer one on ties.  All columns and rows
    stay; NULL texts stay NULL.
    """
    whole = docs.select(F.struct(*docs.columns).alias("row"), F.col(text).alias("body"))
    found = find(whole, "row", "body").withColumnRenamed("doc_id", "row")
    order = F.array_sort(F.transform("spans", lambda s: F.struct(s["first"], (-s["end"]).alias("last"), s["kind"])))
    body = F.col(f"row.`{text}`")
    start = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))

    def add(state: Column, s: Column) -> Column:
        new = F.concat(state["done"], F.substring(body, state["at"] + 1, s["first"] - state["at"]), F.lit("["), s["kind"], F.lit("]"))
        skip = s["first"] < state["at"]
        return F.struct(
            F.when(skip, state["done"]).otherwise(new).alias("done"),
            F.when(skip, F.greatest(state["at"], -s["last"])).otherwise(-s["last"]).alias("at"),
        )

    ended = lambda state: F.concat(state["done"], F.substring(body, state["at"] + 1, F.length(body)))
    masked = F.when(F.size("spans") == 0, body).otherwise(F.aggregate(order, start, add, ended))
    columns = [masked.alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return found.select(*columns)


def report(docs: DataFrame) -> DataFrame:
    """`find` as counts and digests: base spans per kind, their digest, and the places of all spans."""
    places = lambda spans: F.concat_ws(
        ",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["first"].cast("string"), s["end"].cast("string")))
    )
    base = F.filter("spans", lambda s: s["base"])
    count = lambda name: F.size(F.filter("base", lambda s: s["kind"] == name)).cast("bigint")
    return (
        find(docs)
        .select("doc_id", "spans", base.alias("base"))
        .select(
            "doc_id",
            *[count(k.name).alias(f"n_{k.name}") for k in KINDS if k.base],
            F.sha2(places(F.col("base")), 256).alias("base_sha256"),
            places(F.col("spans")).alias("spans"),
            F.size(F.filter("spans", lambda s: s["confirmed"])).cast("bigint").alias("n_confirmed"),
            F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, s: total + s["score"]).alias("score_sum"),
        )
    )
