"""Registered queries of the operators that learn, of the mixture and of token files."""

from __future__ import annotations

from .langid import identify
from .mixing import Mixture, mixture
from .tables import fold, query, table
from .token_files import token_table
from .toxicity import toxicity


@query("op1_language_id")
def op1_language_id(spark, d):
    return identify(table(spark, d, "documents"), fold("doc_id", 4) == 2)


@query("op5_toxicity")
def op5_toxicity(spark, d):
    return toxicity(table(spark, d, "documents"), table(spark, d, "labels"), fold("doc_id", 3) == 1)


@query("op10_mixture")
def op10_mixture(spark, d):
    return mixture(table(spark, d, "documents"), Mixture())


@query("op6_token_files")
def op6_token_files(spark, d):
    return token_table(table(spark, d, "documents"))
