"""DataFrame -> DataFrame operators of the build, the checks and the measures."""
