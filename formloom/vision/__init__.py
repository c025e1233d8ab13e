"""Image kernels in numpy, and their use over columns of images."""
