"""Personal data: patterns propose spans, validators confirm them, words nearby move the score."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from convocases.llm.common import text_of

#: A character that no pattern takes; it marks the borders of matches. In the text it is read as the next character.
_MARK = "\x00"

#: Least score of a span beyond the base kinds, and the reach of its context in characters.
THRESHOLD, REACH = 0.5, 40


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(x: Column) -> Column:
    """Every second digit from the right counts twice, nine taken off above nine; the sum ends in 0."""
    digits = F.reverse(_digits(x))

    def worth(i: Column) -> Column:
        digit = digits.substr(i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, digit).otherwise(digit * 2 - F.when(digit > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, i: s + worth(i)) % 10 == 0


def mod_97(x: Column) -> Column:
    """The first four characters go to the end, letters count from 10, and the whole number is 1 modulo 97."""
    plain = F.replace(x, F.lit(" "), F.lit(""))
    turned = F.concat(plain.substr(F.lit(5), F.length(plain)), plain.substr(F.lit(1), F.lit(4)))
    chars = F.filter(F.split(turned, ""), lambda c: c != "")
    step = lambda s, c: F.when(c.between("0", "9"), (s * 10 + c.cast("int")) % 97).otherwise((s * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(chars, F.lit(0), step) == 1


def _byte(part: Column) -> Column:
    short = F.ltrim(part, F.lit("0"))
    return (F.length(short) <= 3) & (F.concat(F.lit("0"), F.substring(short, 1, 3)).cast("int") <= 255)


@dataclass(frozen=True)
class Kind:
    """A pattern for Java's matcher and what has to hold for a match.

    A text without `hint` has no match. Base kinds have no score: they stay if `valid` holds. The others stay if their
    score, with `bonus` where `context` occurs within REACH characters before them, is at least THRESHOLD.
    """

    name: str
    pattern: str
    valid: Callable[[Column], Column] | None
    hint: str | None = None
    score: float | None = None
    context: str | None = None
    bonus: float = 0.0


#: The base kinds in the order of the digest. Possessive repeats and look-behinds only spare the matcher
#: attempts that must fail and keep its stack flat; at each place they find what the plain pattern finds.
BASE = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", None, "@"),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", lambda x: F.forall(F.split(x, r"\."), _byte), "."),
    Kind("card", r"[0-9](?:[ -]?[0-9]){11,}+", lambda x: F.length(_digits(x)).between(12, 19) & luhn(x)),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", lambda x: F.length(_digits(x)).between(9, 15), "+"),
)

#: What is looked for beyond them.
MORE = (
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}+(?![A-Za-z0-9])", mod_97, None, 0.8,
         r"(?i)\b(iban|account|konto|compte|cuenta)\b", 0.2),
    Kind("ssn", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", None, "-", 0.4,
         r"(?i)\b(ssn|social security)\b", 0.5),
    Kind("local_phone", r"(?<![0-9+().-])[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])", None, None, 0.3,
         r"(?i)\b(phone|telephone|tel|call|mobile|fax|telefon)\b", 0.4),
)
KINDS = BASE + MORE


def _pieces(kind: Kind) -> Column:
    """The text cut at the borders of the matches: pieces alternate between what is no match and what is one."""
    marked = F.regexp_replace(F.translate("text", _MARK, "\x01"), F.lit(kind.pattern), F.lit(f"{_MARK}$0{_MARK}"))
    pieces = F.split(marked, _MARK)
    return F.when(F.col("text").contains(kind.hint), pieces) if kind.hint else pieces


def _placed(pieces: str, number: int) -> Column:
    """Of the pieces that are matches: start s, kind k, end e (exclusive), in code points, and the match x."""
    return F.expr(
        f"aggregate({pieces}, named_struct('n', 0, 'at', 0, 'out', cast(array() as array<struct<s: int, k: int, e: int, x: string>>)),"
        f" (a, x) -> named_struct('n', a.n + 1, 'at', a.at + length(x), 'out', if(a.n % 2 = 1, array_append(a.out,"
        f" named_struct('s', a.at, 'k', {number}, 'e', a.at + length(x), 'x', x)), a.out)), a -> a.out)"
    )


def _stays(kind: Kind, m: Column) -> Column:
    stays = kind.valid(m["x"]) if kind.valid else F.lit(True)
    if kind.score is None:
        return stays
    begin = F.greatest(m["s"] - REACH, F.lit(0))
    bonus = F.when(F.col("text").substr(begin + 1, m["s"] - begin).rlike(kind.context), kind.bonus).otherwise(0.0)
    return stays & (F.lit(kind.score) + bonus >= THRESHOLD)


def _confirmed(kind: Kind, name: str) -> Column:
    stay = F.filter(name, lambda m: _stays(kind, m))
    places = F.transform(stay, lambda m: F.struct(m["s"].alias("s"), m["k"].alias("k"), m["e"].alias("e")))
    return F.coalesce(places, F.expr("cast(array() as array<struct<s: int, k: int, e: int>>)"))


def _of_kind(i: int) -> Column:
    return F.size(F.filter("found", lambda m: m["k"] == i)).cast("long")


def with_spans(docs: DataFrame, text_column: str = "text", into: str = "spans") -> DataFrame:
    """`docs` with an array `into` of confirmed spans (s, k, e): start, number of the kind in KINDS, end (exclusive).

    Places count code points of the whole text; the array goes by start, then kind. Matches of a kind never overlap and
    are found from the left; those that fail their check are dropped and not tried again. Null texts count as empty and
    have no spans. All work stays in one row, so neither hot sources nor long texts gather in a task.
    """
    names = [f"_{kind.name}" for kind in KINDS]
    others = [c for c in docs.columns if c != into]
    work = docs.select(F.struct(*[docs[c] for c in others]).alias("_row"), F.coalesce(docs[text_column].cast("string"), F.lit("")).alias("text"))
    work = work.select("_row", "text", *[_pieces(kind).alias(name) for kind, name in zip(KINDS, names)])
    work = work.select("_row", "text", *[
        F.when(F.size(name) > 1, _placed(name, i)).alias(name) for i, name in enumerate(names)
    ])
    kept = [_confirmed(kind, name) for kind, name in zip(KINDS, names)]
    return work.select("_row", F.array_sort(F.concat(*kept)).alias(into)).select("_row.*", into)


def _joined(spans: Column) -> Column:
    kinds = F.array(*[F.lit(kind.name) for kind in KINDS])
    return F.array_join(F.transform(spans, lambda m: F.concat_ws(
        ":", F.element_at(kinds, m["k"] + 1), m["s"].cast("string"), m["e"].cast("string"))), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, the counts of the base kinds, base_sha256, spans. An empty table gives no rows."""
    found = with_spans(text_of(docs), into="found")
    base = F.filter("found", lambda m: m["k"] < len(BASE))
    counts = [_of_kind(i).alias(f"n_{kind.name}") for i, kind in enumerate(BASE)]
    return found.select(
        "doc_id", *counts, F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """`docs` with each stretch of personal data in `text` replaced by the name of its first kind, as in [email].

    Spans that overlap become one stretch. n_chars, where there is such a column, follows the new text. Texts without
    spans, null ones too, stay as they are.
    """
    spans = "_found"
    while spans in docs.columns:
        spans += "_"
    found = with_spans(docs, into=spans)
    found = found.withColumn(spans, F.expr(
        f"aggregate({spans}, cast(array() as array<struct<s: int, k: int, e: int>>), (a, m) ->"
        " if(size(a) > 0 and m.s < element_at(a, -1).e, concat(slice(a, 1, size(a) - 1), array(named_struct("
        "'s', element_at(a, -1).s, 'k', element_at(a, -1).k, 'e', greatest(element_at(a, -1).e, m.e)))), array_append(a, m)))"
    ))
    kinds = F.array(*[F.lit(f"[{kind.name}]") for kind in KINDS])
    before = lambda i: F.when(i == 0, 0).otherwise(F.get(spans, i - 1)["e"])
    parts = F.transform(spans, lambda m, i: F.concat(
        F.col("text").substr(before(i) + 1, m["s"] - before(i)), F.element_at(kinds, m["k"] + 1)))
    tail = F.expr(f"substring(text, element_at({spans}, -1).e + 1)")
    found = found.withColumn("text", F.when(F.size(spans) > 0, F.concat(F.array_join(parts, ""), tail)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.when(F.size(spans) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return found.select(*docs.columns)
