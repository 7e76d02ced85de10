"""Column functions: canonical values, config maps, record encoding."""
