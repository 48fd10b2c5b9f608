"""Business code lists (P26) and their decoding as a literal map."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Business codes of the commerce database, with English names.
CODES = {
    # order status
    "1001": "unpaid", "1002": "paid", "1003": "cancelled", "1004": "finished",
    "1005": "refunding", "1006": "refunded",
    # payment type
    "1101": "alipay", "1102": "wechat", "1103": "unionpay",
    # appraise
    "1201": "good", "1202": "average", "1203": "bad", "1204": "auto",
    # refund reason
    "1301": "quality problem", "1302": "not as described", "1303": "out of stock",
    "1304": "wrong size", "1305": "ordered by mistake", "1306": "no longer wanted", "1307": "other",
    # coupon status
    "1401": "unused", "1402": "in use", "1403": "used",
    # refund type
    "1501": "money only", "1502": "goods and money",
    # source type
    "2401": "user query", "2402": "promotion", "2403": "recommendation", "2404": "activity",
    # activity rule type
    "3101": "full reduction", "3102": "quantity discount", "3103": "discount",
    # coupon type
    "3201": "full reduction", "3202": "quantity discount", "3203": "voucher",
    # coupon range type
    "3301": "category3", "3302": "trademark", "3303": "spu",
}
KEYWORD_SOURCES = ["SEARCH", "CLICK", "CART", "ORDER"]
APPRAISE_GOOD = "1201"


def decode(code: Column, codes: dict = CODES) -> Column:
    """Code -> name through a literal map (no join, no UDF); unknown -> NULL."""
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(codes.items())])
    return m[code]
