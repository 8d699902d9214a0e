"""The subpackage's queries and their SQL, for the driver."""

from __future__ import annotations

from .op01_urls import op1_urls
from .op02_packing import op2_packing
from .op03_substrings import OP3_SQL, op3_substrings
from .op04_mixing import OP4_SQL, op4_mixing
from .op05_toxicity import op5_toxicity
from .op06_quality import op6_quality
from .op07_secrets import op7_secrets
from .op08_audio import op8_audio_features
from .op09_html import op9_html
from .op10_jaccard import OP10_SQL, op10_jaccard

QUERIES = {
    "op1_urls": op1_urls,
    "op2_packing": op2_packing,
    "op3_substrings": op3_substrings,
    "op4_mixing": op4_mixing,
    "op5_toxicity": op5_toxicity,
    "op6_quality": op6_quality,
    "op7_secrets": op7_secrets,
    "op8_audio_features": op8_audio_features,
    "op9_html": op9_html,
    "op10_jaccard": op10_jaccard,
}

SQL = {
    "op3_substrings": OP3_SQL,
    "op4_mixing": OP4_SQL,
    "op10_jaccard": OP10_SQL,
}
