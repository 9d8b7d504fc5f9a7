"""Folders of the driver's tables.  Not in ``conftest``: two folders of tests have one,
and ``import conftest`` finds whichever was loaded last."""

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
