"""Column-level functions: text normalisation, sentence split, hashing."""

from .hashing import draw, draw_sql, hash_text  # noqa: F401
from .text import (basic_clean, clean_text, combine_answer_comment, combine_fields,  # noqa: F401
                   parse_date, scheme_of_text, shuffle_sentences, split_sentences, token_count,
                   tokenize, tokens_to_string, word_count)
