"""Venue formats to canonical columns, as column expressions; ingest casts are all ``try_`` casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Quote currencies by which a joined symbol is cut, longest first; and the venue's own codes.
QUOTES = ("FDUSD", "USDT", "USDC", "BUSD", "TUSD", "USDP", "BTC", "ETH", "BNB", "EUR", "GBP", "AUD", "BRL", "TRY", "DAI", "USD")
ALIASES = {"XBT": "BTC", "XDG": "DOGE"}


def _alias(code: Column) -> Column:
    out = code
    for old, new in ALIASES.items():
        out = F.when(code == old, F.lit(new)).otherwise(out)
    return out


def split_symbol(symbol: Column) -> tuple[Column, Column]:
    """(base, quote) of a joined symbol such as BTCUSDT; unknown endings are cut before the last four letters."""
    s = F.upper(F.trim(symbol))
    pattern = "^(.+?)(" + "|".join(QUOTES) + ")$"
    quote = F.regexp_extract(s, pattern, 2)
    base = F.regexp_extract(s, pattern, 1)
    rest = F.greatest(F.length(s) - 4, F.lit(0))
    return F.when(quote != "", base).otherwise(s.substr(F.lit(1), rest)), F.when(quote != "", quote).otherwise(F.substring(s, -4, 4))


def joined_canonical(symbol: Column) -> Column:
    """BTCUSDT -> BTC/USDT; a symbol with an unknown ending stays as it is."""
    s = F.upper(F.trim(symbol))
    return F.regexp_replace(s, "^(.+?)(" + "|".join(QUOTES) + ")$", "$1/$2")


def slashed_canonical(pair: Column) -> Column:
    """XBT/USD -> BTC/USD, each leg by itself; a pair without a slash only has its code changed."""
    base, quote = F.substring_index(pair, "/", 1), F.substring_index(pair, "/", -1)
    return F.when(F.instr(pair, "/") > 0, F.concat_ws("/", _alias(base), _alias(quote))).otherwise(_alias(pair))


def dashed_canonical(product: Column) -> Column:
    return F.replace(product, F.lit("-"), F.lit("/"))


def compact(canonical: Column) -> Column:
    return F.replace(canonical, F.lit("/"), F.lit(""))


def currency(canonical: Column, default: str = "UNKNOWN") -> Column:
    """The quote currency of a canonical symbol, or the default."""
    return F.when(F.instr(canonical, "/") > 0, F.substring_index(canonical, "/", -1)).otherwise(F.lit(default))


# Endings by which a joined symbol tells its currency, in order.
SUFFIXES = ("USDT", "USD", "BTC", "ETH")


def suffix_currency(symbol: Column) -> Column:
    """The currency that a joined symbol ends with, else its last four letters."""
    out = F.when(symbol.endswith(SUFFIXES[0]), F.lit(SUFFIXES[0]))
    for suffix in SUFFIXES[1:]:
        out = out.when(symbol.endswith(suffix), F.lit(suffix))
    return out.otherwise(F.substring(symbol, -4, 4))


def fixed_canonical(symbol: Column, suffix: str) -> Column:
    """A joined symbol cut before an ending of known length, whatever stands there."""
    return F.concat(symbol.substr(F.lit(1), F.greatest(F.length(symbol) - len(suffix), F.lit(0))), F.lit(f"/{suffix}"))


def maker_side(buyer_is_maker: Column) -> Column:
    return F.when(buyer_is_maker, "SELL").when(~buyer_is_maker, "BUY").otherwise("UNKNOWN")


def side(code: Column) -> Column:
    c = F.lower(F.trim(code))
    return F.when(c.isin("b", "buy"), "BUY").when(c.isin("s", "sell"), "SELL").when(c.isin("ss", "sell_short"), "SELL_SHORT").otherwise("UNKNOWN")


def order_type(code: Column) -> Column:
    """l and m as a list of conditions; others give an empty list."""
    return F.filter(F.array(F.when(code == "l", "limit").when(code == "m", "market")), lambda x: x.isNotNull())


def decimal(text: Column) -> Column:
    """decimal(18,8), or null for what isn't a number, is negative, or has more digits than fit."""
    value = text.try_cast("decimal(38,18)")
    exact = value.try_cast("decimal(18,8)")
    return F.when((value >= 0) & (exact == value), exact)


def quote_volume(price: Column, quantity: Column) -> Column:
    return (price * quantity).try_cast("decimal(38,8)")


def seconds_text_micros(text: Column) -> Column:
    """Kraken's ``seconds.micros`` text as microseconds, without floating point."""
    return (text.try_cast("decimal(20,6)") * 1_000_000).try_cast("bigint")


def epoch_micros(value: Column) -> Column:
    """Milliseconds or microseconds since 1970, told apart by size, as microseconds."""
    return F.when(value > 10**15, value).otherwise(value * 1000)


def iso_micros(text: Column) -> Column:
    """ISO-8601 text as microseconds; finer digits are cut, what can't be read is null."""
    cut = F.regexp_replace(text, r"(\.\d{6})\d+", "$1")
    return F.unix_micros(F.try_to_timestamp(cut))


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def latency_ms(event_us: Column, ingest_us: Column) -> Column:
    return F.floor((ingest_us - event_us) / 1000)


def message_id(*parts: Column) -> Column:
    """A name that the same record gets on every run."""
    return F.sha2(F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)), 256)


def sequence_of(*parts: Column) -> Column:
    return F.xxhash64(*parts)


def schema_id(value: Column) -> Column:
    """The big-endian schema number of a registry header, or null if the first byte isn't zero or the value is too short."""
    head = F.hex(F.substring(value, 1, 5))
    good = (F.length(value) >= 5) & (F.substring(head, 1, 2) == "00")
    return F.when(good, F.conv(F.substring(head, 3, 8), 16, 10).cast("int"))


def body(value: Column) -> Column:
    return F.when(schema_id(value).isNotNull(), F.substring(value, 6, 1 << 30))
