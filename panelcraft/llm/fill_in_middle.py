"""Fill-in-the-middle rows by counted quantifiers: ``regexp_count`` gives the number of units of a text, and a pattern made
for the row, with possessive groups ``unit{a}+`` and ``unit{b-a}+``, takes prefix, middle and suffix apart in one match.

Units are whole words or single other characters. The two cuts, whether a row is transformed at all and in which order its
parts come hang on a hash of its id alone, so that a rerun, another partitioning or a lost executor changes nothing. All of
it is column expressions: one pass, no shuffle. A possessive group is matched in a loop, so long texts need no deep stack.

Defined results: a null text is empty; an empty text, and one that already holds a sentinel, stays as it is (``plain``);
rows with the same id are cut by the same hash; a null id hashes as the empty string; other columns are dropped.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_text


@dataclass(frozen=True)
class FillInMiddle:
    """``share`` percent of texts are transformed, ``spm_share`` percent of these with the suffix in front.

    Sentinels and the unit are regular expressions' plain text and a pattern of one unit without backtracking.
    """

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    share: int = 90
    spm_share: int = 20
    seed: str = "1"
    unit: str = "[A-Za-z]+|[^A-Za-z]"
    possessive_unit: str = "[A-Za-z]++|[^A-Za-z]"

    def numbers(self, doc_id: Column) -> list[Column]:
        """h1 to h4: the first four groups of eight hex digits of the id's hash."""
        digest = F.sha2(F.concat(F.lit(f"{self.seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
        return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]

    def apply(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """doc_id, text (null as empty), n units, form (plain, psm or spm) and output of every row."""
        rows = id_text(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
        h1, h2, h3, h4 = self.numbers(F.col("doc_id"))
        held = [F.contains(F.col("text"), F.lit(x)) for x in (self.prefix, self.suffix, self.middle)]
        plain = (F.col("text") == "") | held[0] | held[1] | held[2] | (h3 % 100 >= self.share)
        cuts = rows.withColumn("n", F.regexp_count("text", F.lit(self.unit)).cast("long")).select(
            "doc_id", "text", "n",
            F.when(plain, "plain").when(h4 % 100 < self.spm_share, "spm").otherwise("psm").alias("form"),
            F.least(h1 % (F.col("n") + 1), h2 % (F.col("n") + 1)).alias("a"),
            F.greatest(h1 % (F.col("n") + 1), h2 % (F.col("n") + 1)).alias("b"))
        unit = f"((?:{self.possessive_unit}){{"
        pattern = F.concat(F.lit(r"(?s)\A" + unit), F.col("a").cast("string"), F.lit("}+)" + unit),
                           (F.col("b") - F.col("a")).cast("string"), F.lit(r"}+)(.*)\z"))
        psm, spm = (F.lit(x) for x in self._replacements())
        output = F.when(F.col("form") == "plain", F.col("text")).otherwise(
            F.regexp_replace("text", pattern, F.when(F.col("form") == "psm", psm).otherwise(spm)))
        return cuts.select("doc_id", "text", "n", "form", output.alias("output"))

    def _replacements(self) -> tuple[str, str]:
        prefix, suffix, middle = self._escaped()
        return f"{prefix}$1{suffix}$3{middle}$2", f"{suffix}$3{prefix}$1{middle}$2"

    def _escaped(self) -> list[str]:
        """Sentinels as literal text of a replacement."""
        return [x.replace("\\", "\\\\").replace("$", "\\$") for x in (self.prefix, self.suffix, self.middle)]

    def parts(self, output: str = "output", form: str = "form") -> Column:
        """Struct (prefix, middle, suffix) of an output; nulls where the form is plain.

        No part holds a sentinel, so the first place of each one is where it was put.
        """
        text, psm = F.col(output), F.col(form) == "psm"

        def after(x: Column, sentinel: str) -> Column:
            return F.substring(x, F.instr(x, sentinel) + len(sentinel), F.char_length(x))

        def before(x: Column, sentinel: str) -> Column:
            return F.substring(x, F.lit(1), F.instr(x, sentinel) - 1)

        front = after(text, self.prefix)
        prefix = F.when(psm, before(front, self.suffix)).otherwise(before(front, self.middle))
        behind = after(text, self.suffix)
        suffix = F.when(psm, before(behind, self.middle)).otherwise(before(behind, self.prefix))
        cut = F.struct(prefix.alias("prefix"), after(text, self.middle).alias("middle"), suffix.alias("suffix"))
        return F.when(F.col(form) != "plain", cut)

    def restore(self, output: str = "output", form: str = "form") -> Column:
        """The exact text, rebuilt from output and form alone."""
        cut = self.parts(output, form)
        return F.when(F.col(form) == "plain", F.col(output)).otherwise(F.concat(cut["prefix"], cut["middle"], cut["suffix"]))


def digest(docs: DataFrame, transform: FillInMiddle = FillInMiddle()) -> DataFrame:
    """Every row's form, lengths of prefix and middle in code points, and hashes of its output and of the text rebuilt from it."""
    rows = transform.apply(docs).withColumn("cut", transform.parts())
    restored = F.when(F.col("form") == "plain", F.col("output")).otherwise(F.concat("cut.prefix", "cut.middle", "cut.suffix"))
    return rows.select("doc_id", "n", "form", F.char_length("cut.prefix").cast("long").alias("prefix_chars"),
                       F.char_length("cut.middle").cast("long").alias("middle_chars"),
                       F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(restored.cast("binary"), 256).alias("restored_sha256"))


#: The same rows in DuckDB, by lists of units instead of a match.
SQL = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
numbers AS (
  SELECT *, len(u)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM units),
cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
              THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM numbers),
parts AS (
  SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s
  FROM cuts)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
