"""Text functions as columns: normalisation, masking, fingerprints.  Patterns carry (?U) where Unicode classes are meant."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievewright.functions.markup import by_size, markup_to_text, nfc  # noqa: F401  (text functions under one roof)

#: Masks that stand for removed values (fixed values).
EMAIL, PHONE, CARD, IP, ACCOUNT, URL = "<EMAIL>", "<PHONE>", "<PAYMENT_CARD>", "<IP_ADDRESS>", "<ACCOUNT_ID>", "<URL>"

_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
#: Patterns of what is masked, as the rules state them (fixed values).
#: The forms of telephone numbers (fixed values): international, area code in brackets, three groups, leading zero.
PHONE_FORMS = (r"\+[0-9]{1,3}(?:[ -]?[0-9]){7,12}", r"\([0-9]{3}\)[ -][0-9]{3}[ -][0-9]{4}", r"[0-9]{3}[ -][0-9]{3}[ -][0-9]{4}", r"0[0-9]{3}[ -][0-9]{7}")
IPV4_PATTERN = rf"(?<![0-9.])(?=(?:[0-9]{{1,3}}\.){{3}}[0-9]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9]|\.[0-9])"
_BYTE = "(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
IPV4_WORD_PATTERN = rf"(^|[^0-9A-Za-z_.])(?:{_BYTE}\.){{3}}{_BYTE}(\z|[^0-9A-Za-z_.]|\.(?:\z|[^0-9]))"
EMAIL_PATTERN = r"(?iU)(?<![\w.+-])[a-z0-9._%+-]+@[a-z0-9](?:[a-z0-9-]*[a-z0-9])?(?:\.[a-z0-9](?:[a-z0-9-]*[a-z0-9])?)+(?![\w@-])"
PHONE_PATTERN = rf"(?U)(?<!\w)(?:{'|'.join(PHONE_FORMS)})(?!\w)"
CARD_PATTERN = r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,}(?![0-9])"
ACCOUNT_PATTERN = r"(?iU)(?<!\w)(?:ACC|ACCOUNT|CUSTOMER|CUST)-[0-9]{5,}(?![\w-])"
#: A URL goes up to a blank, bracket or quote, or to where the next begins.
URL_PATTERN = r"(?iU)(?<![\w@])(?:https?://|www\.)(?:(?!https?://|www\.)[^\s<>\"'])+"
URL_TAIL = r"[.,!?;:)\]}]+$"


def utrim(c: Column) -> Column:
    """Trim every Unicode blank, not spaces alone."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def strip_controls(c: Column) -> Column:
    return F.regexp_replace(c, r"[\p{Cc}&&[^\n\r\t]]", "")


def unify_newlines(c: Column) -> Column:
    return F.regexp_replace(c, "\r\n?", "\n")


def collapse_punctuation(c: Column) -> Column:
    return F.regexp_replace(c, r"([!?.])\1+", "$1")


def normalize_whitespace(c: Column) -> Column:
    """Blank runs to one blank, lines trimmed, three or more newlines to two, ends trimmed."""
    c = F.regexp_replace(c, r"(?U)[^\S\n]+", " ")
    c = F.array_join(F.transform(F.split(c, "\n", -1), lambda x: F.trim(x)), "\n")
    return utrim(F.regexp_replace(c, r"\n{3,}", "\n\n"))


def _where(c: Column, has, f) -> Column:
    """``f`` of the texts that pass a cheap test, others as they are; the text is bound to a variable and evaluated once."""
    return F.transform(F.array(c), lambda t: F.when(has(t), f(t)).otherwise(t))[0]


def replace_found(text: Column, pattern: str, shown) -> Column:
    """The text with every match of the pattern replaced by ``shown(match)``: cut at the matches and joined again."""
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    return F.array_join(F.zip_with(between, F.transform(found, shown), lambda x, y: F.concat(x, F.coalesce(y, F.lit("")))), "")


def url_tail(url: Column) -> Column:
    """How many characters at a URL's end do not belong to it: sentence marks, and closing brackets that it does not open."""
    marks = F.reverse(F.split(F.regexp_extract(url, URL_TAIL, 0), ""))
    count = lambda text, c: F.length(text) - F.length(F.translate(text, c, ""))

    def step(state: Column, c: Column) -> Column:
        left = F.substring(url, F.lit(1), F.length(url) - state["cut"])
        loose = F.lit(False)
        for opening, closing in ("()", "[]", "{}"):
            loose = loose | ((c == closing) & (count(left, closing) > count(left, opening)))
        go = ~state["stop"] & (c != "") & (c.isin(*".,!?;:") | loose)
        return F.struct((state["cut"] + go.cast("int")).alias("cut"), (~go).alias("stop"))

    return F.aggregate(marks, F.struct(F.lit(0).alias("cut"), F.lit(False).alias("stop")), step, lambda s: s["cut"])


def mask_urls(c: Column) -> Column:
    has = lambda t: t.rlike("[hH][tT][tT][pP][sS]?://|[wW][wW][wW][.]")
    return _where(c, has, lambda t: replace_found(t, URL_PATTERN, lambda u: F.concat(F.lit(URL), F.substring(u, F.length(u) - url_tail(u) + 1, F.length(u)))))


def mask_emails(c: Column) -> Column:
    return _where(c, lambda t: t.contains("@"), lambda t: F.regexp_replace(t, EMAIL_PATTERN, EMAIL))


def mask_ipv4_words(c: Column) -> Column:
    """Masks only addresses without leading zeros that stand as words of their own, each with a character before it that no address before took: the narrower rule that the query's SQL states."""
    return _where(c, lambda t: t.rlike(r"[0-9]\.[0-9]"), lambda t: F.regexp_replace(t, IPV4_WORD_PATTERN, f"$1{IP}$2"))


def mask_ipv4(c: Column) -> Column:
    return _where(c, lambda t: t.rlike(r"[0-9]\.[0-9]"), lambda t: F.regexp_replace(t, IPV4_PATTERN, IP))


def mask_phones(c: Column) -> Column:
    return _where(c, lambda t: t.rlike("[0-9]{3}"), lambda t: F.regexp_replace(t, PHONE_PATTERN, PHONE))


def mask_accounts(c: Column) -> Column:
    return _where(c, lambda t: t.rlike("-[0-9]{5}"), lambda t: F.regexp_replace(t, ACCOUNT_PATTERN, ACCOUNT))


def is_card(digits: Column) -> Column:
    """Luhn's check on 13 to 19 digits that are not all the same."""
    return F.length(digits).between(13, 19) & ~digits.rlike(r"^(.)\1+$") & F.call_function("luhn_check", digits)


def mask_cards(c: Column) -> Column:
    """Only candidates that pass the check are masked."""
    return _where(c, lambda t: t.rlike("[0-9](?:[ -]?[0-9]){12}"), lambda t: replace_found(t, CARD_PATTERN, lambda x: F.when(is_card(F.regexp_replace(x, "[^0-9]", "")), F.lit(CARD)).otherwise(x)))


def mask_pii(c: Column) -> Column:
    """Cards, addresses, phones, account ids, in this order."""
    return mask_accounts(mask_phones(mask_ipv4(mask_cards(c))))


def mask_counts(before: Column, after: Column) -> Column:
    """How many of each mask were added; none for those that weren't."""
    pairs = [x for m in (CARD, IP, PHONE, ACCOUNT) for x in (F.lit(m[1:-1].lower()), (F.regexp_count(after, F.lit(m)) - F.regexp_count(before, F.lit(m))).cast("long"))]
    return F.map_filter(F.create_map(*pairs), lambda _, v: v > 0)


def normalize_native(c: Column) -> Column:
    """All steps but Unicode composition and markup, which need :func:`markup_to_text`."""
    return normalize_whitespace(collapse_punctuation(mask_emails(mask_urls(unify_newlines(strip_controls(c))))))


def fingerprint(subject: Column, message: Column) -> Column:
    """SHA-256 over both fields with their lengths, so that moving text between them changes it; a null subject is empty."""
    s, m = F.coalesce(subject, F.lit("")), F.coalesce(message, F.lit(""))
    return F.sha2(F.concat(F.length(s).cast("string"), F.lit(":"), s, F.length(m).cast("string"), F.lit(":"), m), 256)


def changes(raw: Column, clean: Column, masked: Column) -> dict[str, Column]:
    """Flags and counts of what became of one field: whether cleaning changed it, links and addresses replaced, characters gone, entities masked.  A null field counts nothing."""
    added = lambda mark: F.regexp_count(clean, F.lit(mark)) - F.regexp_count(raw, F.lit(mark))
    out = {"changed": (~raw.eqNullSafe(clean)).cast("long"), "urls": added(URL), "emails": added(EMAIL), "characters_removed": F.length(raw) - F.length(clean), "masked": (~clean.eqNullSafe(masked)).cast("long")}
    return {k: F.coalesce(v.cast("long"), F.lit(0)) for k, v in out.items()}


def word_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(r"(?U)\S+"))


def joined_text(subject: Column, message: Column) -> Column:
    """What classifiers read: both fields trimmed, empty ones left out, a blank line between."""
    return F.array_join(F.filter(F.array(utrim(subject), utrim(message)), lambda x: x.isNotNull() & (x != "")), "\n\n")


def semantic_text(subject: Column, message: Column) -> Column:
    """What the encoder reads: both fields on lines of their own, also an absent subject."""
    return F.concat(F.coalesce(subject, F.lit("")), F.lit("\n"), message)


def language_text(subject: Column, message: Column) -> Column:
    """What language detection reads: the subject's line only if there is one."""
    return F.concat(F.when(F.coalesce(subject, F.lit("")) != "", F.concat(subject, F.lit("\n"))).otherwise(""), message)
