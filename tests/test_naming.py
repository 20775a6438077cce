"""Header names."""

from __future__ import annotations

import pytest

from lendscope.model import HEADER_ALIASES, LOAN_COLUMNS
from lendscope.operators.naming import HeaderCollision, canonical_name, canonical_names, to_snake_case

SNAKE = {
    "BorrName": "borr_name",
    "BORRNAME": "borrname",
    " Borr Name ": "borr_name",
    "L2LocID": "l2_loc_id",
    "CDC_Name": "cdc_name",
    "NAICSCode": "naicscode",
    "2ndField": "2nd_field",
    "__x__": "x",
    "a--b": "a_b",
    "Ümlaut": "mlaut",
}
NAMES = {
    "BorrName": "borrower_name",
    "BORRNAME": "borrower_name",
    "borr_name": "borrower_name",
    "L2LocID": "loan_id",
    "CDC_Name": "cdc_name",
    "CDCName": "cdcname",
    "GrossApproval": "loan_amount",
    "NAICSCode": "naics_code",
    "Something Else": "something_else",
}


@pytest.mark.parametrize(("header", "name"), SNAKE.items())
def test_snake_case(header, name):
    assert to_snake_case(header) == name


@pytest.mark.parametrize(("header", "name"), NAMES.items())
def test_canonical(header, name):
    assert canonical_name(header) == name


def test_every_alias_is_a_column():
    assert len(HEADER_ALIASES) == 46
    assert set(HEADER_ALIASES.values()) <= set(LOAN_COLUMNS)
    assert len(LOAN_COLUMNS) == 54


def test_collision():
    with pytest.raises(HeaderCollision):
        canonical_names(["BorrName", "borr_name"])
