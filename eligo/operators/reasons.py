"""Plain-language reason for each label (a CASE cascade over the same facts as the rules).

The reasons are tied to the rule conditions, not to the leaves of a trained
tree, so they can be recomputed for any data. First match wins.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from eligo import constants as K
from eligo.operators.rules import facts

PENDING_LABELS = (K.AUTOMATIC_PENDING, K.PETITION_PENDING)


def reason_text(label_col: str = "base_label", strict: bool = False) -> Column:
    """Reason for the base label.

    ``strict`` reads the class condition of the petition rules as "none of
    the three" (otherwise any one failing condition suffices, as in the rule
    tables), which makes the class 3/4 and felony texts reachable.
    """
    x = facts()
    pending = F.coalesce(F.col(label_col).isin(*PENDING_LABELS), F.lit(False))
    if strict:
        blocked = x.class3_4 | x.felony10 | x.class1_2
    else:
        blocked = x.class3_4 & x.felony10 & x.class1_2
    misd_conv_blocked = (F.when(x.class1_2, F.lit(K.REASON_MISD_CLASS12))
                         .when(x.class3_4, F.lit(K.REASON_MISD_CLASS34))
                         .otherwise(F.lit(K.REASON_MISD_FELONY_TEN)))
    fel_blocked = (F.when(x.class1_2, F.lit(K.REASON_FEL_CLASS12))
                   .when(x.class3_4, F.lit(K.REASON_FEL_CLASS34))
                   .otherwise(F.lit(K.REASON_FEL_FELONY_TEN)))
    return (
        F.when(x.dismissed & x.felony, F.lit(K.REASON_FELONY_DISMISSAL))
        .when(x.dismissed & x.misdemeanor & x.arrests, F.lit(K.REASON_MISD_DISMISSAL_ARREST))
        .when(x.dismissed & x.misdemeanor & x.convictions, F.lit(K.REASON_MISD_DISMISSAL_CONV))
        .when(x.dismissed & x.misdemeanor, F.lit(K.REASON_MISD_DISMISSAL_CLEAN))
        .when(x.deferral & x.misdemeanor & x.cs_a, F.lit(K.REASON_DEFERRAL_A))
        .when(x.deferral & x.misdemeanor & x.cs_12, F.lit(K.REASON_MISD_12))
        .when(x.deferral & x.misdemeanor, F.lit(K.REASON_DEFERRAL_OTHER))
        .when(x.conviction & x.misdemeanor & x.cs_12, F.lit(K.REASON_MISD_12))
        .when(x.conviction & x.misdemeanor & x.sevenyear, F.lit(K.REASON_MISD_CONV_SEVEN))
        .when(x.conviction & x.misdemeanor & (x.cs_a | x.cs_b) & pending, F.lit(K.REASON_MISD_B_PENDING))
        .when(x.conviction & x.misdemeanor & (x.cs_a | x.cs_b), F.lit(K.REASON_MISD_B))
        .when(x.conviction & x.misdemeanor & blocked, misd_conv_blocked)
        .when(x.conviction & x.misdemeanor & pending, F.lit(K.REASON_MISD_OK_PENDING))
        .when(x.conviction & x.misdemeanor, F.lit(K.REASON_MISD_OK))
        .when((x.conviction | x.deferral) & x.felony & x.cs_12, F.lit(K.REASON_FEL_12))
        .when((x.conviction | x.deferral) & x.felony & x.tenyear, F.lit(K.REASON_FEL_TEN))
        .when((x.conviction | x.deferral) & x.felony & blocked, fel_blocked)
        .when((x.conviction | x.deferral) & x.felony & pending, F.lit(K.REASON_FEL_OK_PENDING))
        .when((x.conviction | x.deferral) & x.felony, F.lit(K.REASON_FEL_OK))
    )
