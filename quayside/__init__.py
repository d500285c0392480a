"""Record landing on Spark: decode, envelope, route, pack, land and account for offsets."""
