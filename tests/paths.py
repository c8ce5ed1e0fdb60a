"""Where the tests find their tables (a module of its own name: every test folder has a ``conftest``)."""

import os

SF_SMALL = os.environ.get("LEDGERLAKE_TEST_SF", "/root/testdata/sf0.001")
SF_ORACLE = os.environ.get("LEDGERLAKE_ORACLE_SF", "/root/testdata/sf0.01")
