"""Column names of the versioned subscription fact."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class SubscriptionColumns:
    """Names under which a versioned subscription table holds its fields.

    One row is one rate plan of one version of one subscription.
    """

    account: str = "account_id"
    sub_name: str = "sub_name"
    version: str = "sub_version"
    status: str = "sub_status"
    term_type: str = "term_type"
    renewal_term: str = "renewal_term"
    term_start: str = "term_start"
    sub_created: str = "sub_created"
    cancelled: str = "cancelled"
    rate_plan_id: str = "rp_id"
    rate_plan: str = "rp_name"
    rate_plan_created: str = "rp_created"
    product: str = "product_name"
    family: str = "product_family"
    amend_type: str = "amend_type"
    amend_effective: str = "amend_eff"
    amend_sub: str = "amend_sub_id"
    previous_sub: str = "prev_id"
    mrr: str = "mrr"
    tcv: str = "tcv"
    charged_through: str = "charged_through"
    currency: str = "currency"


DEFAULT_COLUMNS = SubscriptionColumns()

# Fixed values of the amendment type field.
NEW_PRODUCT = "NewProduct"
REMOVE_PRODUCT = "RemoveProduct"
UPDATE_PRODUCT = "UpdateProduct"
