"""Constants of the tests, importable by one name from any folder below."""

SF_SMALL = "/root/testdata/sf0.001"
