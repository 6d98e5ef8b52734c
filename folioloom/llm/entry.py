"""The queries of this subpackage, for the driver's entry point."""

from __future__ import annotations

from .chat import ORACLE as CHAT_SQL
from .chat import op12_chat
from .clusters import ORACLE as CLUSTERS_SQL
from .clusters import op13_clusters
from .decontaminate import op9_decontamination
from .language import op2_language
from .licenses import ORACLE as LICENSES_SQL
from .licenses import op7_licenses
from .packing import op10_packing
from .pii import op4_pii
from .quality import op6_quality
from .secrets import op5_secrets
from .simhash import op8_simhash
from .suffixes import op3_suffixes
from .toxicity import op1_toxicity
from .windows import ORACLE as WINDOWS_SQL
from .windows import op11_windows

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_language": op2_language,
    "op3_suffixes": op3_suffixes,
    "op4_pii": op4_pii,
    "op5_secrets": op5_secrets,
    "op6_quality": op6_quality,
    "op7_licenses": op7_licenses,
    "op8_simhash": op8_simhash,
    "op9_decontamination": op9_decontamination,
    "op10_packing": op10_packing,
    "op11_windows": op11_windows,
    "op12_chat": op12_chat,
    "op13_clusters": op13_clusters,
}

#: The others have no SQL form that stays cheap on whole tables; tests/llm holds brute-force versions.
ORACLE_SQL: dict[str, str] = {"op7_licenses": LICENSES_SQL, "op11_windows": WINDOWS_SQL, "op12_chat": CHAT_SQL, "op13_clusters": CLUSTERS_SQL}
