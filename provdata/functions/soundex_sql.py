"""Soundex for the DuckDB oracle (DuckDB has no ``soundex``).

Pure SQL equal to Spark's ``soundex`` on upper-cased, trimmed input
(checked on 43,495 distinct words): first letter kept; H/W first letters are
transparent; letters map to digits 1-6, vowels 0, H/W 7 (dropped without
separating equal codes); runs collapsed; zeros dropped; padded to 3 digits.
"""

from __future__ import annotations

_TEMPLATE = """(case when {t} = '' then '' when not regexp_matches(substr({t},1,1),'[A-Z]') then {t}
else substr({t},1,1) || substr(rpad(replace(substr(
  regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
    (case when substr({t},1,1) in ('H','W') then '0'
          else translate(substr({t},1,1),'ABCDEFGHIJKLMNOPQRSTUVWXYZ','01230127022455012623017202') end)
    || replace(regexp_replace(translate(substr({t},2),'ABCDEFGHIJKLMNOPQRSTUVWXYZ','01230127022455012623017202'),'[^0-7]','0','g'),'7','')
  ,'1+','1','g'),'2+','2','g'),'3+','3','g'),'4+','4','g'),'5+','5','g'),'6+','6','g')
  ,2),'0',''),3,'0'),1,3) end)"""


def soundex_sql(expr: str) -> str:
    """Soundex key of ``expr`` (trimmed + upper-cased here); blank -> NULL like ``soundex_key``."""
    t = f"upper(trim({expr}))"
    return f"(case when {t} <> '' then {_TEMPLATE.format(t=t)} end)"
