"""Where the tests read the driver's smallest tables."""

SF_SMALL = "/root/testdata/sf0.001"
