from strata.plans.collection import (
    collect_by,
    collection_by_source,
    monthly_by_unit,
    monthly_income,
    payments_by_unit,
    top_income_months,
    weekly_collection,
)
from strata.plans.debtors import owner_debts, top_debtors
from strata.plans.derive import (
    derive_extra_expenses,
    derive_ordinary_expenses,
    financial_state,
    financial_state_since,
    prorate,
    prorate_since,
)
from strata.plans.expenses import category_chart, category_expense, monthly_expenses, top_expense_months
from strata.plans.gaps import payment_gaps
from strata.plans.ledger import load_ledger, load_months
from strata.plans.loading import (
    assign_people,
    assignment_rejects,
    import_assignments,
    import_buildings,
    import_expenses,
    import_payments,
    import_people,
    import_units,
)

__all__ = [
    "assign_people",
    "assignment_rejects",
    "category_chart",
    "category_expense",
    "collect_by",
    "collection_by_source",
    "derive_extra_expenses",
    "derive_ordinary_expenses",
    "financial_state",
    "financial_state_since",
    "import_assignments",
    "import_buildings",
    "import_expenses",
    "import_payments",
    "import_people",
    "import_units",
    "load_ledger",
    "load_months",
    "monthly_by_unit",
    "monthly_expenses",
    "monthly_income",
    "owner_debts",
    "payment_gaps",
    "payments_by_unit",
    "prorate",
    "prorate_since",
    "top_debtors",
    "top_expense_months",
    "top_income_months",
    "weekly_collection",
]
