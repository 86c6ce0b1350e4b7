"""Text clean-up and labels as column expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from chatloom.functions.scripts import mended, transliterated

#: An e-mail address takes its whole run of non-blanks, so matching starts at runs only, which keeps long runs without @ linear.
URL, EMAIL, PHONE, CURRENCY = r"http\S+", r"(?<!\S)\S+@\S+", r"\+?\d[\d -]{8,}\d", r"[$€₹¥]"
MARKERS = r"[!]{2,}|[?]{2,}|[.]{3,}"
NOT_WORD = r"[^\p{L}\p{N}_\s]"


def strip(c: Column) -> Column:
    """Without white space at both ends, no-break spaces included."""
    return F.regexp_replace(c, r"^[\s ]+|[\s ]+$", "")


def word_count(c: Column) -> Column:
    return F.size(F.filter(F.split(c, r"\s+"), lambda w: w != "")).cast("long")


def without_contacts(c: Column) -> Column:
    """Without URLs, e-mail addresses, phone numbers and currency signs, in this order."""
    for p in (URL, EMAIL, PHONE, CURRENCY):
        c = F.regexp_replace(c, p, "")
    return c


def squeezed(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def clean_english(c: Column) -> Column:
    """Lower case, letters, digits and underscores only, single blanks."""
    return squeezed(F.regexp_replace(F.lower(without_contacts(c)), NOT_WORD, " "))


def urgency_markers(c: Column) -> Column:
    """The first two of runs such as !!, ?? and ..., joined by blanks."""
    return F.array_join(F.slice(F.regexp_extract_all(c, F.lit(MARKERS), F.lit(0)), 1, 2), " ")


def clean_message(c: Column) -> Column:
    """The cleaned text with its markers at the end."""
    marks = urgency_markers(c)
    return F.trim(F.concat(clean_english(c), F.when(marks == "", "").otherwise(F.concat(F.lit(" "), marks))))


def utm_value(c: Column) -> Column:
    """Lower case without outer blanks; words that mean nothing are null."""
    v = F.lower(strip(F.regexp_replace(c, " ", " ")))
    return F.when(v.isin("", "none", "nan", "null"), None).otherwise(v)


def page_slug(url: Column) -> Column:
    """Path without scheme, query and fragment, anything but word characters and hyphens as _, at most 50 characters."""
    path = F.regexp_replace(F.regexp_replace(url, r"^[a-z]+://[^/]*/?", ""), r"[?#].*$", "")
    return F.substring(F.regexp_replace(path, r"[^A-Za-z0-9_\-]", "_"), 1, 50)


def canonical_key(labels: Column) -> Column:
    """A list of labels sorted and written as JSON in lower case, so that order and case don't matter."""
    return F.lower(F.concat(F.lit('["'), F.array_join(F.array_sort(labels), '", "'), F.lit('"]')))


def labels_of(value: Column) -> Column:
    """Labels of a JSON list, a list in single quotes, a list encoded twice, or a plain string."""
    once = F.coalesce(F.get_json_object(value, "$"), value)
    text = F.when(value.startswith('"'), once).otherwise(value)
    json = F.from_json(text, "array<string>")
    quoted = F.from_json(F.regexp_replace(text, "'", '"'), "array<string>")
    return F.when(text.startswith("["), F.coalesce(json, quoted, F.array(text))).when(text == "", F.array().cast("array<string>")).otherwise(F.array(text))


def clean_title(new: Column, old: Column) -> Column:
    """A suggested title without quotes, unless it has over five words or under three characters."""
    t = F.trim(F.regexp_replace(new, "[\"']", ""))
    return F.when((word_count(t) > 5) | (F.length(t) < 3), old).otherwise(t)


def twelve_hour(hour: Column) -> Column:
    h = F.when(hour % 12 == 0, 12).otherwise(hour % 12)
    return F.concat(h.cast("string"), F.when(hour < 12, " AM").otherwise(" PM"))


def ordinal_day(day: Column) -> Column:
    d = day.cast("int")
    end = F.when((d % 100).between(11, 13), "th").when(d % 10 == 1, "st").when(d % 10 == 2, "nd").when(d % 10 == 3, "rd").otherwise("th")
    return F.concat(d.cast("string"), end)


def json_reply(reply: Column) -> Column:
    """The JSON list in a model's reply: code fences go, then from the first [ to the last ]."""
    bare = F.regexp_replace(reply, r"```(json)?", "")
    found = F.regexp_extract(bare, r"(?s)\[.*\]", 0)
    return F.when(found == "", None).otherwise(found)


# Other languages ------------------------------------------------------------------------------------------------------

#: Spellings that count as one word, in the order in which they are replaced.
HINGLISH = {
    "aap": ["aap", "ap", "app", "aapka"],
    "hai": ["hai", "h", "he", "hain"],
    "kya": ["kya", "kyaa", "kia"],
    "nahi": ["nahi", "nhi", "nahin", "na"],
    "haan": ["haan", "han", "haa", "ha"],
    "bahut": ["bahut", "bhut", "boht", "bahot"],
    "paisa": ["paisa", "paise", "paesa", "pesa"],
    "kitna": ["kitna", "kitne", "kitni"],
    "mujhe": ["mujhe", "muje", "mjhe", "mughe"],
    "chahiye": ["chahiye", "chahie", "chaiye", "chiye"],
    "theek": ["theek", "thik", "thek"],
    "accha": ["accha", "acha", "achha", "achaa"],
}
INDIAN = ("hi", "bn", "ta", "te", "mr", "gu", "kn", "ml", "pa", "ur", "or", "as")


@F.pandas_udf(StringType())
def nfc(texts: pd.Series) -> pd.Series:
    """Canonical composition."""
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


@F.pandas_udf(StringType())
def without_accents(texts: pd.Series) -> pd.Series:
    """Letters without their marks: the part of a transliteration that needs no tables."""
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFC", "".join(c for c in unicodedata.normalize("NFD", t) if not unicodedata.combining(c))))


def one_spelling(c: Column) -> Column:
    """Words of HINGLISH in their first spelling, whole words in any case, group by group."""
    for word, spellings in HINGLISH.items():
        c = F.regexp_replace(c, rf"(?iU)\b(?:{'|'.join(spellings)})\b", word)
    return c


def words_only(c: Column) -> Column:
    return squeezed(F.regexp_replace(c, NOT_WORD, " "))


def clean_in(c: Column, language: Column) -> Column:
    """The cleaned text by language: English as it is, Indian languages in one spelling, others in Latin letters; composed and mended first, markers last."""
    text = mended(nfc(c))
    low = F.lower(strip(without_contacts(text)))
    indian = F.coalesce(language.rlike("hi|^(?:" + "|".join(INDIAN) + ")"), F.lit(False))
    body = F.when(F.coalesce(language.startswith("en"), F.lit(True)), words_only(low)).when(indian, words_only(one_spelling(low))).otherwise(words_only(transliterated(low)))
    marks = urgency_markers(text)
    return F.trim(F.concat(body, F.when(marks == "", "").otherwise(F.concat(F.lit(" "), marks))))


def phrase_text(phrase: Column) -> Column:
    """A phrase cleaned as messages are; as it is if nothing is left."""
    cleaned = clean_english(phrase)
    return F.when(cleaned == "", phrase).otherwise(cleaned)


# Times, numbers and JSON ----------------------------------------------------------------------------------------------

ISO = r"^(\d{4}-\d{2}-\d{2})(?:[T ](\d{2}:\d{2})(:\d{2})?(?:[.,]\d{1,9})?)?(?:Z|[+-]\d{2}:?\d{2})?$"


def local_from_iso(c: Column, minutes: int = 330) -> Column:
    """An ISO-8601 time as local "yyyy-MM-dd HH:mm:ss"; its own offset is overwritten by UTC, what isn't a time is null."""
    part = lambda k: F.regexp_extract(c, ISO, k)
    time = F.when(part(2) == "", "00:00").otherwise(part(2))
    plain = F.concat_ws("", part(1), F.lit(" "), time, F.when(part(3) == "", ":00").otherwise(part(3)))
    at = F.when(c.rlike(ISO), plain).try_cast("timestamp_ntz")
    return F.date_format(at + F.make_dt_interval(mins=F.lit(minutes)), "yyyy-MM-dd HH:mm:ss")


def json_first(c: Column, field: str) -> Column:
    """A field of a JSON object, of a list its first element; null if there is none."""
    value = F.get_json_object(c, f"$.{field}")
    return F.when(value.startswith("["), F.get_json_object(c, f"$.{field}[0]")).otherwise(value)


def json_flag(c: Column, field: str) -> Column:
    """1 if a field of a JSON object, which may be encoded twice, is true, a number but 0, or a text but "false" or an empty one; else 0."""
    once = F.get_json_object(c, "$")
    value = F.get_json_object(F.when(F.ltrim(c).startswith('"'), once).otherwise(c), f"$.{field}")
    return F.coalesce((~value.isin("false", "0", "0.0", "", "[]", "{}")).cast("int"), F.lit(0))


def round_half_even(c: Column, digits: int) -> Column:
    """Rounded as the binary number that it is, ties to the even digit: 2.675 gives 2.67 and 0.125 gives 0.12."""

    @F.pandas_udf(DoubleType())
    def rounded(values: pd.Series) -> pd.Series:
        return values.map(lambda v: v if pd.isna(v) else round(v, digits))

    return rounded(c.cast("double"))


def thousands(c: Column, sign: str = "₹") -> Column:
    return F.concat(F.lit(sign), F.format_number(c, 0))


def tenant_slug(c: Column) -> Column:
    """Lower case, runs of anything but letters and digits as one underscore."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def product_handle(html: Column) -> Column:
    """The name after /products/ in the first link that has one; null if there is none."""
    return F.nullif(F.regexp_extract(html, r"href=[\"'][^\"']*/products/([^\"'/?#]+)", 1), F.lit(""))


# Labels ---------------------------------------------------------------------------------------------------------------

#: Shown names of use cases.
USE_CASE_NAMES = {
    "Product Info": "Product details",
    "Contact Details": "Customer care details",
    "Seeking Solution": "Product to solve specific issue",
    "Order Status": "Order status",
    "Unsure About Effectiveness": "Product efficacy doubts",
    "Differentiation": "Comparison with another brand",
    "Place Order": "Place an order",
    "Product Ingredients": "Product ingredients",
    "Delivery Time": "Delivery timeline",
    "Customer Information": "Personal information",
    "Pricing": "Pricing",
    "Cancellation": "Order cancellation",
    "Payment": "Payment process",
    "Return/Refund Policy": "Return or refund policy",
    "Address Change": "Change delivery address",
    "Wrong/Damaged Order": "Wrong or damaged order",
    "Certification": "Product certification",
    "Discount": "Discounts or offers",
    "Talk to Agent": "Speak to a human agent",
    "E-commerce/Quick Commerce": "Availability on other platforms",
    "Comparison": "Comparison between products",
    "Out of Stock": "Product availability",
    "Feedback": "Feedback or complaint",
    "B2B Queries": "Bulk or distribution order",
    "About Team": "Company or team information",
    "Benefits": "Product benefits",
    "Book Consultation": "Book a consultation",
    "Combined Usage": "Using products together",
    "Competitor": "Competitor products",
    "Customer Product Requirement": "Product needs or requirements",
    "Durability and Quality": "Durability or quality",
    "Energy Efficiency": "Energy efficiency",
    "Flavor Options": "Flavor options",
    "Greetings": "Greeting or courtesy",
    "How to Use": "Product usage",
    "Longevity": "Product longevity",
    "Material and Finish": "Material or finish",
    "No Query": "No specific query",
    "Nutrition Info": "Nutrition information",
    "Pairing Info": "Product pairing",
    "Physical Store": "Physical store locations",
    "Product Features": "Product features",
    "Product Installation": "Product installation",
    "Product Not Working": "Product not working",
    "Product Suitability": "Suitability for specific needs or skin type",
    "Safety Features": "Safety features",
    "Shelf Life Storage": "Shelf life or storage",
    "Similar Product": "Similar products",
    "Sizing Chart": "Sizing or size chart",
    "Space and Size Fit": "Space or size compatibility",
    "Specialty": "Specialty products",
    "Warranty": "Warranty information",
    "Website Issue": "Website issue",
}
#: Use cases that count as one; a null one counts as none.
USE_CASE_SYNONYMS = {
    "Seeking Solution": ["Seeking Solution", "Customer Problem"],
    "Feedback": ["Feedback", "Complaint"],
    "Product Info": ["Product Info", "All Products", "product_benefits"],
    "E-commerce/Quick Commerce": ["ecommerce_quick_commerce", "E-commerce/Quick Commerce"],
    "Unsure About Effectiveness or Side Effects": ["side_effect", "side_effects", "Unsure About Effectiveness"],
    "Inquiry about stores or availability on other platforms": ["store", "physical_store", "Inquiry about availability on other platforms"],
    "Inquiry about durability or quality": ["durability", "durability_and_quality"],
    None: ["No More Product Query"],
}
#: Words of which any makes a cluster a post-sales one.
POST_SALES = [
    "delivery", "delivered", "track", "tracking", "cancel",
    "cancellation", "return", "refund", "exchange", "shipped",
    "received", "dispatch", "dispatched",
    "logistics", "shipment", "courier", "transit",
    "replacement", "damaged", "wrong product", "not received",
]
#: Titles and descriptions of clusters that say nothing.
NOISE_PATTERNS = [
    r"\bgreetings?\b", r"\breplies?\b", r"\backnowledg\w+\b",
    r"\brandom\b", r"\bmiscellaneous\b", r"\boutliers?\b",
    r"\bgeneral\b.*\breplies?\b", r"\bgeneral\b.*\bgreetings?\b",
    r"\bcasual\b.*\bmessages?\b", r"\bbrief\b.*\bmessages?\b",
]
#: Words in titles of clusters whose messages are looked at, and texts that say nothing.
NOISE_TITLES = ["greeting", "acknowledgment", "general", "casual", "brief"]
NOISE_TEXTS = ["hi", "hey", "hello", "ok", "yes", "no", "thanks", "bye", "yeah", "shut up", "hindi"]
#: What a theme list says if there was too little to go by.
INSUFFICIENT = [
    "no statistically significant patterns",
    "insufficient data for theme extraction",
    "insufficient message volume",
    "not enough data",
    "no patterns detected",
]


def one_use_case(c: Column) -> Column:
    out = c
    for name, spellings in USE_CASE_SYNONYMS.items():
        out = F.when(c.isin(*spellings), F.lit(name)).otherwise(out)
    return out


def shown_use_case(c: Column) -> Column:
    return F.coalesce(F.create_map(*(F.lit(x) for kv in USE_CASE_NAMES.items() for x in kv))[c], c)


def any_of(c: Column, parts: list[str]) -> Column:
    """Whether c has any of the parts."""
    out = F.lit(False)
    for p in parts:
        out = out | c.contains(p)
    return out


def sales_stage(name: Column, description: Column) -> Column:
    text = F.lower(F.concat_ws(" ", name, description))
    return F.when(any_of(text, POST_SALES), "post-sales").otherwise("pre-sales")


def says_nothing(title: Column, description: Column) -> Column:
    """Whether a title and description match one of NOISE_PATTERNS."""
    return F.lower(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(description, F.lit("")))).rlike("(?s)" + "|".join(NOISE_PATTERNS))


def greets(text: Column) -> Column:
    low = F.lower(strip(text))
    return (F.length(low) <= 3) | any_of(low, NOISE_TEXTS)


def insufficient(themes: Column) -> Column:
    """Whether a list of themes is empty or null or says so."""
    return F.coalesce(F.size(themes) <= 0, F.lit(True)) | F.coalesce(F.exists(themes, lambda t: any_of(F.lower(strip(t)), INSUFFICIENT)), F.lit(False))
