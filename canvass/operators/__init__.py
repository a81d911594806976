"""Survey-pull operators: each is a ``DataFrame -> DataFrame`` function."""
