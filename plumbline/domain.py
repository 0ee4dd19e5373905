"""What the operators need to know about a table: column roles and corruption tables.

``CREDIT`` describes credit applications (21 data columns); ``Domain.renamed`` carries
its parameters over to a table with other column names.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from plumbline.operators.expectations.suite import Expectation, Suite

LEVELS = ("light", "medium", "severe")


def level(scenario: str) -> str:
    """Anything that is neither light nor medium counts as severe."""
    return scenario if scenario in LEVELS[:2] else "severe"


@dataclass(frozen=True)
class Outliers:
    probability: Mapping[str, float]
    multiplier: Mapping[str, tuple[float, float]]
    extreme_share: float


@dataclass(frozen=True)
class Domain:
    columns: Mapping[str, str]  # data columns in contract order, with their stored type
    target: str
    amount: str
    duration: str
    age: str
    age_range: tuple[float, float]
    key_columns: tuple[str, ...]
    missing_counts: Mapping[str, Mapping[str, int]]
    outliers: Mapping[str, Outliers]
    extreme_values: Mapping[str, tuple[float, ...]]
    extreme_multiplier: Mapping[str, tuple[float, float]]
    invalid_values: Mapping[str, tuple[str, ...]]
    category_errors: Mapping[str, tuple[float, tuple[str, ...]]]
    label_flip: Mapping[str, float]
    relation: Mapping[str, float]

    @property
    def mean_filled(self) -> tuple[str, ...]:
        return (self.amount, self.duration, self.age)

    @property
    def features(self) -> list[str]:
        return [c for c in self.columns if c != self.target]

    def renamed(self, roles: Mapping[str, str], columns: Mapping[str, str],
                extreme_values: Mapping[str, tuple[float, ...]]) -> "Domain":
        """The same parameters for another table; roles it does not have drop out."""
        def keyed(table):
            return {roles[c]: v for c, v in table.items() if c in roles}
        return replace(
            self, columns=columns, target=roles[self.target], amount=roles[self.amount],
            duration=roles[self.duration], age=roles[self.age],
            key_columns=tuple(roles[c] for c in self.key_columns if c in roles),
            missing_counts={k: keyed(v) for k, v in self.missing_counts.items()},
            outliers={k: Outliers(keyed(v.probability), keyed(v.multiplier), v.extreme_share)
                      for k, v in self.outliers.items()},
            extreme_values=extreme_values, extreme_multiplier=keyed(self.extreme_multiplier),
            invalid_values=keyed(self.invalid_values),
            category_errors={k: (p, tuple(roles[c] for c in cs if c in roles))
                             for k, (p, cs) in self.category_errors.items()},
        )


# --- fixed values: the credit table, its valid domains and its corruption levels ------

CREDIT_COLUMNS = {
    "checking_account_status": "string", "duration_in_month": "int", "credit_history": "string",
    "purpose": "string", "credit_amount": "int", "savings_account_bonds": "string",
    "employment": "string", "installment": "int", "status_n_sex": "string",
    "other_debtors_guarantors": "string", "residence": "int", "property": "string",
    "age_in_years": "int", "other_installment_plans": "string", "housing": "string",
    "existing_credits_no": "int", "job": "string", "liability_responsibles": "int",
    "telephone": "string", "foreign_worker": "string", "category": "int",
}

CREDIT_VALUES = {
    "checking_account_status": ["A11", "A12", "A13", "A14"],
    "credit_history": ["A30", "A31", "A32", "A33", "A34"],
    "purpose": ["A40", "A41", "A42", "A43", "A44", "A45", "A46", "A48", "A49", "A410"],
    "savings_account_bonds": ["A61", "A62", "A63", "A64", "A65"],
    "foreign_worker": ["A201", "A202"],
    "property": ["A121", "A122", "A123", "A124"],
    "status_n_sex": ["A91", "A92", "A93", "A94"],
    "employment": ["A71", "A72", "A73", "A74", "A75"],
    "other_debtors_guarantors": ["A101", "A102", "A103"],
    "other_installment_plans": ["A141", "A142", "A143"],
    "housing": ["A151", "A152", "A153"],
    "job": ["A171", "A172", "A173", "A174"],
    "telephone": ["A191", "A192"],
    "category": [1, 2],
}

CREDIT_RANGES = {
    "credit_amount": (250, 20000), "duration_in_month": (4, 72), "age_in_years": (19, 75),
    "installment": (1, 4), "residence": (1, 4), "existing_credits_no": (1, 4),
    "liability_responsibles": (1, 2),
}

CREDIT_REQUIRED = (
    "checking_account_status", "credit_history", "purpose", "savings_account_bonds", "foreign_worker",
    "property", "status_n_sex", "credit_amount", "duration_in_month", "age_in_years", "category",
)

CREDIT = Domain(
    columns=CREDIT_COLUMNS,
    target="category", amount="credit_amount", duration="duration_in_month", age="age_in_years",
    age_range=(18, 100),
    key_columns=(
        "checking_account_status", "credit_history", "purpose", "credit_amount", "duration_in_month",
        "age_in_years", "savings_account_bonds", "foreign_worker", "category",
    ),
    missing_counts={
        "light": {"checking_account_status": 20, "credit_history": 30, "credit_amount": 20,
                  "duration_in_month": 20},
        "medium": {"checking_account_status": 40, "credit_history": 50, "credit_amount": 40,
                   "duration_in_month": 40, "purpose": 40, "age_in_years": 50},
        "severe": {"checking_account_status": 20, "credit_history": 30, "credit_amount": 20,
                   "duration_in_month": 80, "purpose": 50, "age_in_years": 50,
                   "savings_account_bonds": 60, "foreign_worker": 50},
    },
    outliers={
        "light": Outliers(
            {"credit_amount": 0.02, "duration_in_month": 0.02, "age_in_years": 0.02},
            {"credit_amount": (3, 6), "duration_in_month": (3, 6), "age_in_years": (1.5, 2.5)}, 0.20),
        "medium": Outliers(
            {"credit_amount": 0.04, "duration_in_month": 0.04, "age_in_years": 0.03, "installment": 0.03},
            {"credit_amount": (5, 8), "duration_in_month": (5, 8), "age_in_years": (2, 3),
             "installment": (2, 3)}, 0.30),
        "severe": Outliers(
            {"credit_amount": 0.07, "duration_in_month": 0.06, "age_in_years": 0.07, "installment": 0.05,
             "residence": 0.05},
            {"credit_amount": (7, 12), "duration_in_month": (6, 10), "age_in_years": (2.5, 4),
             "installment": (3, 6), "residence": (3, 6)}, 0.40),
    },
    extreme_values={
        "credit_amount": (50000, 100000, 250000), "duration_in_month": (120, 180, 240),
        "age_in_years": (100, 120, 150), "residence": (15, 20, 25),
    },
    extreme_multiplier={"installment": (4, 6)},
    invalid_values={
        "checking_account_status": ("X99", "INVALID", "A99", ""),
        "credit_history": ("X99", "ERROR", "A99", "OTHER"),
        "purpose": ("X99", "INVALID", "A99", "OTHER"),
        "savings_account_bonds": ("X99", "ERROR", "A99", ""),
        "foreign_worker": ("X99", "INVALID", "A99", "AER"),
        "property": ("X99", "ERROR", "A125", "A126", "A89"),
        "status_n_sex": ("X99", "INVALID", "A95", "A96", ""),
    },
    category_errors={
        "light": (0.03, ("checking_account_status", "credit_history", "purpose")),
        "medium": (0.05, ("checking_account_status", "credit_history", "purpose",
                          "savings_account_bonds", "foreign_worker")),
        "severe": (0.08, ("checking_account_status", "credit_history", "purpose",
                          "savings_account_bonds", "foreign_worker", "property", "status_n_sex")),
    },
    label_flip={"light": 0.02, "medium": 0.5, "severe": 0.08},
    relation={"light": 0.02, "medium": 0.05, "severe": 0.08},
)
# --- end of fixed values --------------------------------------------------------------


def credit_suite() -> Suite:
    """The 33 rules of the credit table, from its domains: not-null, in-set, range, target, pair."""
    target = CREDIT.target
    found = [Expectation("expect_column_values_to_not_be_null", {"column": c}) for c in CREDIT_REQUIRED if c != target]
    found += [Expectation("expect_column_values_to_be_in_set", {"column": c, "value_set": v})
              for c, v in CREDIT_VALUES.items() if c != target]
    found += [Expectation("expect_column_values_to_be_between", {"column": c, "min_value": lo, "max_value": hi})
              for c, (lo, hi) in CREDIT_RANGES.items()]
    # the target's set comes before its presence
    found.append(Expectation("expect_column_values_to_be_in_set", {"column": target, "value_set": CREDIT_VALUES[target]}))
    found.append(Expectation("expect_column_values_to_not_be_null", {"column": target}))
    found.append(Expectation("expect_column_pair_values_A_to_be_greater_than_B", {
        "column_A": "credit_amount", "column_B": "duration_in_month", "or_equal": True}))
    return Suite(tuple(found), name="credit_applications", data_asset_name="credit_applications")
