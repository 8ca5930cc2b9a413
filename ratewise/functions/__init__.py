from ratewise.functions.codec import (
    day_text, decode_user, encode_ids, encode_message, encode_scored, number_text, pair_key,
    random_key,
)
from ratewise.functions.text import (
    field, java_double, java_float, java_int, java_long, java_split, jtrim,
)
from ratewise.functions.vector import dot, truncate

__all__ = [
    "day_text", "decode_user", "encode_ids", "encode_message", "encode_scored", "number_text",
    "pair_key", "random_key", "field", "java_double", "java_float", "java_int", "java_long",
    "java_split", "jtrim", "dot", "truncate",
]
