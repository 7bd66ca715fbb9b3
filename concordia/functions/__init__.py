from .canonical import CanonicalOptions, canonical_columns, canonical_text
from .fingerprint import bucket_of, fingerprint, hash_number, with_bucket
from .type_category import type_category

__all__ = [
    "CanonicalOptions",
    "bucket_of",
    "canonical_columns",
    "canonical_text",
    "fingerprint",
    "hash_number",
    "type_category",
    "with_bucket",
]
